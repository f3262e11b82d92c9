"""Change capture against a stored state: new, modified, unchanged and deleted records, as one join.

A batch may repeat an id; its rows count in their order (seq), each against the one before. Fields outside the content
hash change unseen. A record that comes back unchanged after it was deleted stays deleted, unless revive_unchanged.
An empty batch of a source deletes nothing, so an outage is no mass deletion.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import checked

NEW, MODIFIED, DELETED = "NUEVO", "MODIFICADO", "ELIMINADO"
#: Fields that an update leaves as they were first stored.
KEPT_ON_UPDATE = {"fuente", "tipo_sujeto", "id_fuente_original"}


#: Per record of a merge: rows of the batch that were new, changed, unchanged, and whether the record became deleted.
COUNTS = ["nuevos", "modificados", "sin_cambio", "eliminados"]


def _per_id(batch: DataFrame, picked: list[str], id_col: str, hash_col: str, seq_col: str) -> DataFrame:
    """One row an id of the batch: its first row, its last row that differs from the row before, and how many do or don't."""
    w = Window.partitionBy(id_col).orderBy(seq_col)
    x = batch.withColumn("__k", F.row_number().over(w)).withColumn("__prev", F.lag(hash_col).over(w))
    later, differs = F.col("__k") > 1, ~F.col(hash_col).eqNullSafe(F.col("__prev"))
    return x.groupBy(F.col(id_col).alias("__id")).agg(
        F.min_by(F.struct(*picked), seq_col).alias("__first"), F.max_by(F.struct(*picked), F.when(later & differs, F.col(seq_col))).alias("__later"),
        F.count_if(later & differs).alias("__mods"), F.count_if(later & ~differs).alias("__same"),
    )


def merge(
    batch: DataFrame, state: DataFrame, id_col: str = "id_registro", hash_col: str = "hash_contenido", seq_col: str = "seq", source_col: str = "fuente",
    active_col: str = "activo", delete_missing: bool = True, revive_unchanged: bool = False, seen: DataFrame | None = None, mark: str | None = None,
) -> DataFrame:
    """The next state, every id of batch or state once, with estado_carga and COUNTS; one full join.

    The last change of an id in the batch wins. delete_missing: stored records of a source that the batch has rows of,
    and that it lacks, become deleted and inactive. seen: those sources, where batch is a part of what came. mark: the
    name of a further column, whether the stored row has to change.
    """
    columns = [c for c in state.columns if c != "estado_carga"]
    # Fields that updates keep come from the id's first row, the others from its last change.
    per_id = _per_id(batch, [c for c in columns if c != id_col], id_col, hash_col, seq_col)
    sources = checked((batch if seen is None else seen).select(F.col(source_col).alias("__source")).distinct().withColumn("__seen", F.lit(True)))
    x = state.join(per_id, F.col(id_col) == F.col("__id"), "full_outer").join(sources, F.col(source_col) == F.col("__source"), "left")
    stored, sent = F.col(id_col).isNotNull(), F.col("__id").isNotNull()
    first_differs = stored & sent & ~F.col(hash_col).eqNullSafe(F.col("__first")[hash_col])
    last = F.coalesce(F.col("__later"), F.when(~stored | first_differs, F.col("__first")))
    changed = sent & last.isNotNull()
    gone = stored & ~sent & F.col("__seen").isNotNull() & ~F.col("estado_carga").eqNullSafe(DELETED) if delete_missing else F.lit(False)
    back = stored & sent & ~changed & (F.col("estado_carga") == DELETED) if revive_unchanged else F.lit(False)
    out = []
    for c in columns:
        if c == id_col:
            value = F.coalesce(F.col(id_col), F.col("__id"))
        else:
            fresh = F.col("__first")[c] if c in KEPT_ON_UPDATE else last[c]
            updated = F.col(c) if c in KEPT_ON_UPDATE else last[c]
            value = F.when(~stored, fresh).when(changed, updated).otherwise(F.col(c))
            if c == active_col:
                value = F.when(gone, F.lit(False)).when(back, F.lit(True)).otherwise(value)
        out.append(value.alias(c))
    mods = F.coalesce("__mods", F.lit(0))
    status = F.when(~stored & (mods > 0), MODIFIED).when(~stored, NEW).when(changed, MODIFIED).when(gone, DELETED).when(back, MODIFIED).otherwise(F.col("estado_carga"))
    one = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    counts = [one(~stored), mods + one(first_differs), F.coalesce("__same", F.lit(0)) + one(stored & sent & ~first_differs), one(gone)]
    marked = [F.coalesce(~stored | changed | gone | back, F.lit(False)).alias(mark)] if mark else []
    return x.select(*out, status.alias("estado_carga"), *[n.cast("long").alias(name) for name, n in zip(COUNTS, counts)], *marked)


def upsert(batch: DataFrame, state: DataFrame, **how) -> DataFrame:
    """The next state alone."""
    return merge(batch, state, **how).drop(*COUNTS)


def tally(merged: DataFrame) -> DataFrame:
    """One row: COUNTS of a merge, summed."""
    return merged.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])


def change_counts(batch: DataFrame, state: DataFrame, **how) -> DataFrame:
    """One row: COUNTS of the batch against the state."""
    return tally(merge(batch, state, **how))


def keep_last(df: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    """Replace-insert: one row an id, the last by seq."""
    last = Window.partitionBy(id_col).orderBy(F.desc(seq_col))
    return df.withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")


@dataclass
class SnapshotTable:
    """A Parquet table in versions: a snapshot is written beside the others, then named current by one rename."""

    spark: SparkSession
    root: str

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def versions(self) -> list[int]:
        if not self._fs().exists(self._path("")):
            return []
        names = [f.getPath().getName() for f in self._fs().listStatus(self._path(""))]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def read(self, schema: str | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            if schema is None:
                raise ValueError(f"no snapshot in {self.root}")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/v{known[-1]:09d}")

    def stage(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Writes df beside the versions, where read() doesn't see it; the draft's name."""
        draft = f"draft-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.root}/{draft}")
        return draft

    def staged(self, draft: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{draft}")

    def publish(self, draft: str, version: int | None = None) -> int:
        """Makes a draft the given version, the next by default, by one rename; fails if another writer took it (as
        surely as the file system renames: HDFS and its like at once, local disks and object stores look first)."""
        version = (self.versions() or [0])[-1] + 1 if version is None else version
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._path(draft), self._path(f"v{version:09d}"), none)
        except Exception as e:
            self._fs().delete(self._path(draft), True)
            raise RuntimeError(f"version {version} of {self.root} was taken") from e
        return version

    def commit(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Writes df as the next version."""
        version = (self.versions() or [0])[-1] + 1
        return self.publish(self.stage(df, partition_by), version)
