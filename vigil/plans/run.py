"""The whole run: ingest, quality, portfolio, screening, evaluation, monitoring, reports."""

from __future__ import annotations

import argparse
import json
import logging
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitoring, quality
from ..operators.bucket_state import BucketState
from ..operators.cdc import COUNTS
from ..operators.screening import Settings, alert_counts, evaluate, evaluation_samples, index_sizes, score_summary, screen
from ..operators.synthetic import portfolio
from ..schemas import INGESTION_LOG, SOURCES
from ..sources.fetch import land_source
from ..sources.registry import READERS, ingest

log = logging.getLogger("vigil.run")


#: Settings by environment.
ENVIRONMENTS = {"local": Settings()}


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_report(spark: SparkSession, rows: list[dict] | dict, path: str) -> None:
    """A small result as indented JSON, wherever Spark can write; what JSON doesn't know is written as text."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(json.dumps(rows, indent=2, ensure_ascii=False, default=str).encode())
    finally:
        out.close()


def save_csv(df: DataFrame, path: str, compression: str = "none") -> bool:
    """df as CSV with a header; nothing is written if it is empty. df is computed once: its files are written beside path, and take its place."""
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    spark, aside = df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    flat.write.option("header", True).option("compression", compression).csv(aside)
    there, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if spark.read.option("header", True).schema(flat.schema).csv(aside).isEmpty():
        files.delete(there, True)
        return False
    files.delete(target, True)
    if not files.rename(there, target):
        raise OSError(f"{aside} can't be renamed to {path}")
    return True


def read_parties(spark: SparkSession, path: str) -> DataFrame:
    """A portfolio from CSV: texts only, nulls as empty texts, the planted flag as a number."""
    x = spark.read.option("header", True).csv(path)
    return x.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c != "es_match_plantado" else F.col(c).cast("int").alias(c) for c in x.columns])


def ingest_all(spark: SparkSession, landing: dict[str, str], state: BucketState, run_ts: str, quarantine: str) -> tuple[DataFrame, DataFrame]:
    """Merges every source into the state, of which only buckets with a change are written: (this run's records, ingestion log rows).

    Records that can't be parsed, and sources that can't be read, are written to the folder quarantine (fuente, record,
    reason), under this run's time; the log counts the former as errors.
    """
    records, logs = None, []
    for name, path in landing.items():
        began, rejects = time.time(), []
        found, reason = ingest(spark, name, path, run_ts, rejects)
        found = found.withColumn("seq", F.monotonically_increasing_id())
        n = found.count()
        counts = state.merge(found).counts if n else dict.fromkeys(COUNTS, 0)
        if reason is not None:
            rejects = [spark.createDataFrame([(name, None, reason)], "fuente string, record string, reason string")]
        aside = reduce(DataFrame.unionByName, rejects) if rejects else None
        errors = aside.count() if aside is not None else 0
        if errors:
            log.warning("%s: %d records are set aside", name, errors)
            aside.withColumn("run_ts", F.lit(run_ts)).write.mode("append").parquet(quarantine)
        end = time.time()
        if reason is None:
            stamp = datetime.fromtimestamp(began, timezone.utc), datetime.fromtimestamp(end, timezone.utc)
            logs.append((name, *stamp, n, counts["nuevos"], counts["modificados"], counts["eliminados"], errors, end - began, "OK"))
        records = found if records is None else records.unionByName(found)
    return records, spark.createDataFrame(logs, INGESTION_LOG)


def synthetic_parties(spark: SparkSession, sanctions: DataFrame, root: str, total: int, planted: int, reuse: bool) -> DataFrame:
    """The synthetic portfolio, saved under root with the map of what was planted; an earlier one if it is to be used again."""
    rows, made = f"{root}/portfolio", f"{root}/planted"
    if not (reuse and _exists(spark, f"{rows}/_SUCCESS") and _exists(spark, f"{made}/_SUCCESS")):
        for df, path in zip(portfolio(sanctions, total, planted), (rows, made)):
            df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(rows)


def run(
    spark: SparkSession, landing: dict[str, str], root: str, run_ts: str, settings: Settings = Settings(), total: int = 10_000, planted: int = 800, only_matching: bool = False,
    parties_csv: str | None = None, reuse_portfolio: bool = False,
) -> dict:
    """All phases over landed files; reports under root/reports. Returns the summary."""
    state = BucketState(spark, f"{root}/state")
    metrics, summary, checks, records = monitoring.empty_metrics(spark), {"run_ts": run_ts}, [], None
    if not only_matching:
        began = time.time()
        records, logs = ingest_all(spark, landing, state, run_ts, f"{root}/quarantine")
        logs.write.mode("append").parquet(f"{root}/ingestion_log")
        counts = records.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"))
        expected = spark.createDataFrame([(s,) for s in landing], "fuente string").join(counts, "fuente", "left").select("fuente", F.coalesce("n", F.lit(0)).alias("n"))
        metrics = metrics.unionByName(monitoring.ingestion_metrics(expected, time.time() - began, run_ts))
        checks = [r.asDict() for r in quality.report(records, {"today": run_ts[:10]}, [r for r in quality.RULES if r is not quality.ALERT_RULE]).collect()]
        save_report(spark, [r.asDict() for r in logs.collect()], f"{root}/reports/ingestion.json")
    sanctions = state.current()
    parties = read_parties(spark, parties_csv) if parties_csv else synthetic_parties(spark, sanctions, root, total, planted, reuse_portfolio)
    parties = parties.persist()
    began = time.time()
    history = monitoring.AlertHistory(spark, root)
    alerts = history.store(screen(parties, sanctions, settings, run_ts), run_ts)
    history.refresh(sanctions, parties)
    scores = score_summary(alerts, settings.high, settings.low).first().asDict()
    seconds, n = time.time() - began, parties.count()
    # Alerts can be checked only now; the report holds all rules.
    checks += [r.asDict() for r in quality.report(sanctions, {"alerts": alerts, "parties": parties, "sanctions": sanctions}, [quality.ALERT_RULE]).collect()]
    summary |= {"quality_passed": all(r["passed"] for r in checks), "quality_errors": sum(r["error_count"] for r in checks)}
    save_report(spark, {"passed": summary["quality_passed"], "total_errors": summary["quality_errors"], "rules": checks}, f"{root}/reports/quality.json")
    result = scores | {"total_terceros": n, "tiempo_segundos": round(seconds, 2), "registros_por_segundo": round(n / seconds, 1), "index": index_sizes(sanctions, settings).first().asDict()}
    result |= {"evaluation": evaluate(alerts, parties).first().asDict(), "samples": [r.asDict() for r in evaluation_samples(alerts, parties).collect()]}
    result |= {"counts": [r.asDict() for r in alert_counts(alerts).collect()], "first_alerts": [r.asDict() for r in alerts.orderBy("id_tercero", "id_registro").limit(10).collect()]}
    save_report(spark, result, f"{root}/reports/matching.json")
    save_csv(alerts, f"{root}/reports/alerts_csv", "gzip")
    metrics = metrics.unionByName(monitoring.matching_metrics(alerts, parties, run_ts))
    metrics.write.mode("append").parquet(f"{root}/metrics")
    found, failed = monitoring.evaluate_each(spark.read.parquet(f"{root}/metrics"), run_ts)
    fired = [r.asDict() for r in found.collect()]
    save_report(spark, {"fired": fired, "failed_rules": failed, "metrics": [r.asDict() for r in monitoring.latest(metrics).collect()]}, f"{root}/reports/monitoring.json")
    return summary | result | {"fired": fired}


def main(arguments: list[str] | None = None, download: Callable[..., bool] = land_source) -> int:
    parser = argparse.ArgumentParser(description="Screens a portfolio against public sanctions lists.")
    parser.add_argument("--landing", required=True, help="folder for the lists, one file or folder a source, named like it")
    parser.add_argument("--root", required=True, help="folder for state, alerts, metrics and reports")
    parser.add_argument("--env", default="local", choices=sorted(ENVIRONMENTS), help="the settings to use")
    parser.add_argument("--skip-download", action="store_true", help="use lists that have landed, and the portfolio of the last run")
    parser.add_argument("--only-matching", action="store_true", help="screen against the stored state")
    parser.add_argument("--sources", default=",".join(SOURCES))
    parser.add_argument("--parties", help="a portfolio in CSV instead of a synthetic one")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    names = [s.strip() for s in given.sources.split(",") if s.strip()]
    for name in names:
        if name not in READERS:
            log.warning("unknown source %s is skipped", name)
    landing = {n: f"{given.landing}/{n}" for n in names if n in READERS}
    if not given.only_matching:
        for name in landing:
            if not download(name, given.landing, given.skip_download):
                log.error("%s could not be fetched and has not landed before", name)
    spark = SparkSession.builder.appName("vigil").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    run(spark, landing, given.root, now, ENVIRONMENTS[given.env], only_matching=given.only_matching, parties_csv=given.parties, reuse_portfolio=given.skip_download)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
