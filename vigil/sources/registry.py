"""Readers by source name, and their records in canonical form."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW
from ..staging import staged
from .canonical import canonical
from .delimited import read_delimited
from .files import read_debarred
from .hits import read_hits
from .xml_lists import read_eu, read_sdn, read_un

log = logging.getLogger("vigil.sources")

#: reader(spark, path, today, rejects); rejects gets tables of what is set aside (xml_lists.REJECTED).
READERS: dict[str, Callable[[SparkSession, str, str, list[DataFrame]], DataFrame]] = {
    "OFAC": lambda spark, path, today, rejects: read_sdn(spark, path, rejects),
    "UN": lambda spark, path, today, rejects: read_un(spark, path, rejects),
    "EU": lambda spark, path, today, rejects: read_eu(spark, path, rejects=rejects),
    "FCPA": lambda spark, path, today, rejects: read_hits(spark, path, rejects=rejects),
    "PACO_DISC": lambda spark, path, today, rejects: read_delimited(spark, path, "PACO_DISC", zipped=True),
    "PACO_PENAL": lambda spark, path, today, rejects: read_delimited(spark, path, "PACO_PENAL"),
    "WORLD_BANK": lambda spark, path, today, rejects: read_debarred(spark, path, today),
}


def ingest(spark: SparkSession, name: str, path: str, run_ts: str, rejects: list[DataFrame] | None = None) -> tuple[DataFrame, str | None]:
    """A source's canonical records and, where it is unknown or can't be read, no records and the reason.

    The records are written once, here, so whatever fails in them fails here, be it the first row or the last, and
    other sources go on. Records that are set aside are appended to rejects (fuente, record, reason).
    """
    empty = canonical(spark.createDataFrame([], RAW), run_ts)
    if name not in READERS:
        return empty, f"unknown source {name}"
    try:
        aside: list[DataFrame] = []
        records = staged(canonical(READERS[name](spark, path, run_ts[:10], aside), run_ts), f"records-{name}")
        if rejects is not None:
            rejects += [staged(df.select(F.lit(name).alias("fuente"), "record", "reason"), "rejected") for df in aside]
        return records, None
    except Exception as e:  # one broken source must not stop the others; the reason is logged and returned
        log.error("%s: %s", name, e)
        return empty, str(e)
