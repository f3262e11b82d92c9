"""Incremental screening: new files of canonical records are merged into the state, and only what changed is screened."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bucket_state import BucketState
from ..operators.cdc import MODIFIED, NEW
from ..operators.screening import Settings, screen
from ..schemas import SANCTION


def merge_and_screen(batch: DataFrame, state: BucketState, parties: DataFrame, alerts_path: str, run_id: str, run_ts: str, settings: Settings = Settings(), delete_missing: bool = False) -> int:
    """Merges a batch (with seq) into the state and writes the alerts of new and modified entries; the number of those.

    The alerts are a partition run_id=... of alerts_path, and are written before the state is published. So a run that
    is repeated under its run_id after a failure writes the same alerts over those of the first try or, if the state was
    published too, finds nothing changed and leaves them. run_id must be the same for a repeat, and no other batch's.
    """
    draft = state.stage(batch, delete_missing=delete_missing)
    changed = state.rows(draft, changed_only=True).where(F.col("estado_carga").isin(NEW, MODIFIED))
    n = changed.count()
    if n:
        screen(parties, changed, settings, run_ts).write.mode("overwrite").parquet(f"{alerts_path}/run_id={run_id}")
    if draft.touched:
        state.publish(draft)
    return n


def start(spark: SparkSession, landing: str, state_root: str, parties: DataFrame, alerts_path: str, checkpoint: str, run_ts: str, settings: Settings = Settings()) -> StreamingQuery:
    """A file stream over Parquet files of canonical records (with seq) that takes all there is and stops.

    Files seen before are not read again. A batch keeps its number when it is repeated after a failure, so its alerts
    are written once; batches of other checkpoint folders have other run ids.
    """
    stream = spark.readStream.schema(SANCTION + ", seq long").parquet(landing)
    state, name = BucketState(spark, state_root), hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def each(batch: DataFrame, batch_id: int) -> None:
        merge_and_screen(batch.persist(), state, parties, alerts_path, f"{name}-{batch_id}", run_ts, settings)
        batch.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and means of events by window and type, for streams (late events past the watermark are dropped) and tables alike."""
    ts = F.col("ts").cast("timestamp")
    marked = events.withColumn("ts", ts)
    marked = marked.withWatermark("ts", late) if events.isStreaming else marked
    return marked.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")).select(
        F.col("w.start").alias("window_start"), "event_type", "n", "mean_value")
