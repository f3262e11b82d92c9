"""Token counts through a digest cache: stored counts are joined by content and tokenizer digests, only distinct misses
are encoded, and their counts are appended to the cache.

The cache is a Parquet table (digest, n_tokens) in a folder for each tokenizer version. The content digest is SHA-256
of the normalised text; a byte-level tokenizer normalises nothing, so by default only null becomes empty. Texts are
encoded where they are read: of the rows to encode and those to skip, the fewer are broadcast, or a filter of fixed
size stands for them, so no text is shuffled until both are more than common.FILTER_KEYS.

Defined cases: null text counts as empty (0 tokens); rows repeated, or texts repeated under other ids, are encoded
once and all get the count; null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import FILTER_KEYS, attach_groups, equal, holding, lacking, ship, written
from .encoding import encoder, tokenizer_digest


def _count(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            n = [len(encode(x.as_py())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return run


def _cached(spark, folder: str) -> DataFrame:
    empty = spark.createDataFrame([], "digest binary, n_tokens long")
    try:
        found = spark.read.schema(empty.schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two runs may have appended the same digest


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    tokenizer: the tokenizer's file, at the same path on all machines. cache: a folder that all machines share.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    text = F.coalesce(F.col(text_col), F.lit("")).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2(normalise(F.col("text")), 256)))
    rows = written(source.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "count-rows")
    sizes = written(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")), "count-sizes")
    misses = written(sizes.join(_cached(spark, folder).select("digest"), "digest", "left_anti").select("digest", "first_id"), "count-misses")
    n_rows, n_misses = rows.count(), misses.count()
    if n_misses:
        # The first row of each missed class is encoded. Whichever are fewer, those rows or the others, are known to the scan.
        first = misses.select("digest", F.col("first_id").alias("doc_id"))
        if min(n_misses, n_rows - n_misses) > FILTER_KEYS:
            todo = source.alias("s").join(first.alias("m"), equal("s", "m", ["digest", "doc_id"]), "left_semi")
        elif n_misses <= n_rows - n_misses:
            todo = holding(source, first)
        else:
            others = rows.alias("s").join(first.alias("m"), equal("s", "m", ["digest", "doc_id"]), "left_anti").select("digest", "doc_id").distinct()
            todo = lacking(source, rows, written(others, "count-others"))
        counted = todo.select("digest", "text").mapInArrow(_count(tokenizer), "digest binary, n_tokens long")
        counted.dropDuplicates(["digest"]).write.mode("append").parquet(folder)  # repeated rows give a digest twice
    known = sizes.join(_cached(spark, folder), "digest").select("digest", "n", "n_tokens")
    out = attach_groups(rows, known, "digest", "n", n_rows)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
