"""From raw documents to packed training sequences: filter, dedup twice, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet and reads again for the
next stage. All but the last return the columns of docs; mixing keeps every row, its decision is the order in which the
written files hold them, and packing follows that order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import drop_table, fresh_path, table, tables_since
from vigil.llm.exact_dedup import drop_exact
from vigil.llm.mixing import mixed_order
from vigil.llm.ngram_join import drop_near
from vigil.llm.packing import pack_in_order
from vigil.llm.quality_rules import drop_rejected
from vigil.llm.queries import MIX_WEIGHTS, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_rejected(docs, table(spark, sf_dir, "labels"), risk=0.05, delta=0.05)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs, keep="max")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs, words=5, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_order(docs, MIX_WEIGHTS, other=1.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_in_order(docs, tokenizer_path(), capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's intermediate tables, and the input it read, go when its output is written."""
    docs, old = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        n, path = len(tables_since(spark)), fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        for done in [*old, *tables_since(spark, n)]:
            drop_table(spark, done)
        docs, old = spark.read.parquet(path), [path]
    return docs
