"""Data-quality rules: each names the rows that break it; a report counts them.

A rule on single rows is a condition and a detail; all of them are evaluated in one pass over the records, which leaves a
narrow table (ids, source, hash, order, and what each row breaks). Rules over many rows read that table, if it has the
columns that they name, else the records. A rule of another kind is a function (records, context) -> DataFrame(detail
string). A user's own rules go into RULES or the `rules` argument.

Rules are evaluated apart: one that can't be (a column that is missing, an error in it) breaks itself, with the reason as
its detail, and leaves the others as they are. Counts are true counts; capped_count is the count as a report that stops
at `cap` errors would give it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import SOURCES
from ..staging import staged
from .joins import checked

log = logging.getLogger("vigil.quality")

Context = dict[str, object]
#: The columns that rules over many rows read.
NARROW = ["id_registro", "fuente", "id_fuente_original", "hash_contenido", "seq"]


@dataclass(frozen=True)
class Rule:
    """row: (records, context) -> (condition, parts of the detail), for rules on single rows. violations: any other rule,
    over records that have `columns`, or all of them if that is None."""

    name: str
    description: str
    violations: Callable[[DataFrame, Context], DataFrame] | None = None
    capped: bool = True
    row: Callable[[DataFrame, Context], tuple[Column, list[Column]]] | None = None
    columns: tuple[str, ...] | None = None


def _text(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def _detail(df: DataFrame, *parts) -> DataFrame:
    return df.select(_text(list(parts)).alias("detail"))


def source_missing(records: DataFrame, context: Context) -> tuple[Column, list[Column]]:
    return F.col("fuente").isNull() | (F.col("fuente") == ""), [F.col("id_registro")]


def source_without_records(records: DataFrame, context: Context) -> DataFrame:
    expected = records.sparkSession.createDataFrame([(s,) for s in context.get("expected_sources", SOURCES)], "fuente string")
    return _detail(expected.join(records.select("fuente").distinct(), "fuente", "left_anti"), F.col("fuente"))


def aliases_not_a_list(records: DataFrame, context: Context) -> tuple[Column, list[Column]]:
    """On typed records nothing can break this; raw JSON text can."""
    if dict(records.dtypes)["aliases"].startswith("array"):
        return F.lit(False), [F.col("id_registro")]
    return F.col("aliases").isNotNull() & F.from_json("aliases", "array<string>").isNull(), [F.col("id_registro")]


def sanction_in_future(records: DataFrame, context: Context) -> tuple[Column, list[Column]]:
    """A date that can't be read lies nowhere."""
    today = F.lit(context["today"]).cast("date") if "today" in context else F.current_date()
    return F.col("fecha_sancion").try_cast("date") > today, [F.col("id_registro"), F.col("fecha_sancion")]


def hash_changes_within_batch(records: DataFrame, context: Context) -> DataFrame:
    """A record whose hash differs from the one before of the same source and original id. Order: the column `seq`."""
    before = Window.partitionBy("fuente", "id_fuente_original").orderBy("seq")
    x = records.withColumn("__prev", F.lag(F.struct("hash_contenido")).over(before))
    return _detail(x.where(F.col("__prev").isNotNull() & ~F.col("hash_contenido").eqNullSafe(F.col("__prev.hash_contenido"))), F.col("fuente"), F.col("id_fuente_original"))


def alert_without_reference(records: DataFrame, context: Context) -> DataFrame:
    """Alerts that name no known third party or no known record; nothing without context["alerts"]."""
    alerts = context.get("alerts")
    if alerts is None:
        return _detail(records.where(F.lit(False)), F.col("id_registro"))
    parties, sanctions = context["parties"], context.get("sanctions", records)
    lost = alerts.join(parties.select("id_tercero").distinct(), "id_tercero", "left_anti").select("id_tercero", "id_registro", F.lit("tercero").alias("lacks"))
    other = alerts.join(sanctions.select("id_registro").distinct(), "id_registro", "left_anti").select("id_tercero", "id_registro", F.lit("registro").alias("lacks"))
    return _detail(lost.unionByName(other), F.col("lacks"), F.col("id_tercero"), F.col("id_registro"))


def names_empty(records: DataFrame, context: Context) -> tuple[Column, list[Column]]:
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return blank("nombres") & blank("apellidos"), [F.col("id_registro")]


def active_not_boolean(records: DataFrame, context: Context) -> tuple[Column, list[Column]]:
    if dict(records.dtypes)["activo"] == "boolean":
        return F.col("activo").isNull(), [F.col("id_registro")]
    return ~F.coalesce(F.col("activo").cast("string").isin("0", "1", "true", "false"), F.lit(False)), [F.col("id_registro")]


#: The rule that needs context["alerts"] and context["parties"].
ALERT_RULE = Rule("alerta_referencias_validas", "alerts refer to known rows", alert_without_reference)
RULES = [
    Rule("fuente_no_nula", "every record names its source", capped=False, row=source_missing),
    Rule("fuente_con_registros", "every expected source has records", source_without_records, capped=False, columns=("fuente",)),
    Rule("aliases_como_lista", "aliases are a list", row=aliases_not_a_list),
    Rule("fecha_sancion_no_futura", "no sanction lies in the future", row=sanction_in_future),
    Rule("hash_unico_por_fuente", "one content for an original id", hash_changes_within_batch, columns=("fuente", "id_fuente_original", "hash_contenido", "seq")),
    ALERT_RULE,
    Rule("nombres_no_vacios", "every record has a name", row=names_empty),
    Rule("activo_es_booleano", "activo is a boolean", row=active_not_boolean),
]


def violations(records: DataFrame, context: Context | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """All rows that break a rule: (rule, detail). The records are read once, and once more for each rule that needs all of them."""
    context, failed, found, parts = context or {}, [], [], []

    def fails(rule: Rule, reason: Exception) -> None:
        log.error("rule %s: %s", rule.name, reason)
        failed.append((rule.name, f"the rule failed: {str(reason).splitlines()[0]}"))

    for rule in (r for r in rules if r.row):
        try:
            condition, detail = rule.row(records, context)
            one = F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(rule.name).alias("rule"), _text(detail).alias("detail")))
            records.select(one)  # a column that is missing shows here
            parts.append(one)
        except Exception as e:  # the other rules go on
            fails(rule, e)
    there = [c for c in NARROW if c in records.columns]
    wide = [r for r in rules if not r.row]
    if parts or any(r.columns is not None for r in wide):
        broken = F.filter(F.array(*parts), lambda x: x.isNotNull()) if parts else F.lit(None).cast("array<struct<rule: string, detail: string>>")
        narrow = staged(records.select(*there, broken.alias("__broken")), "rules")
        found.append(narrow.select(F.explode("__broken").alias("x")).select("x.rule", "x.detail"))
    for rule in wide:
        try:
            whole = rule.violations(records if rule.columns is None else narrow.drop("__broken"), context)
            # Written apart, so that an error within it is its own.
            found.append(staged(whole.select(F.lit(rule.name).alias("rule"), "detail"), "rule"))
        except Exception as e:
            fails(rule, e)
    found.append(records.sparkSession.createDataFrame(failed, "rule string, detail string"))
    return reduce(DataFrame.unionByName, found)


def report(records: DataFrame, context: Context | None = None, rules: list[Rule] = RULES, cap: int = 20, sample: int = 5) -> DataFrame:
    """One row a rule: rule, description, passed, error_count, capped_count, errors_sample (the least details)."""
    found = violations(records, context, rules)  # narrow tables that are written already
    counted = found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    # The least details, ranked with a limit that each task applies before the shuffle.
    least = found.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy("detail"))).where(F.col("k") <= sample)
    samples = least.groupBy("rule").agg(F.sort_array(F.collect_list("detail")).alias("errors_sample"))
    names = records.sparkSession.createDataFrame([(r.name, r.description, r.capped) for r in rules], "rule string, description string, capped boolean")
    x = names.join(checked(counted), "rule", "left").join(checked(samples), "rule", "left")
    n = F.coalesce("n", F.lit(0))
    return x.select(
        "rule", "description", (n == 0).alias("passed"), n.alias("error_count"), F.when(F.col("capped"), F.least(n, F.lit(cap))).otherwise(n).alias("capped_count"),
        F.coalesce("errors_sample", F.array().cast("array<string>")).alias("errors_sample"),
    )
