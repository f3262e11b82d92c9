"""The stored state in hash buckets, of which a merge reads and writes only those where something changes.

A record's bucket is a hash of its id. A version of the state is a manifest: for every bucket the folder that holds it.
A merge first compares ids and hashes alone, over a narrow projection of the state, which tells the buckets with a new,
modified, deleted or revived record. Only those are read whole, merged and written, all in one new folder; the new
manifest takes the other buckets' folders over from the version before, and is published by one rename that never
replaces. So readers see whole versions, a failed merge leaves the version before, and of two that build on the same
version one wins.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STATE
from .cdc import COUNTS, DELETED, merge

NARROW = ["id_registro", "fuente", "hash_contenido", "activo", "estado_carga"]


@dataclass
class Draft:
    """A merge that is written but not published: the version it makes, its buckets' folders, and what it counted."""

    version: int
    buckets: dict[int, str]
    touched: list[int]
    counts: dict[str, int]


@dataclass
class BucketState:
    """root holds data/<merge>/bucket=<b>/ and manifests/v<version>. n_buckets is fixed by the first version."""

    spark: SparkSession
    root: str
    n_buckets: int = 64
    schema: str = STATE

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self._path("manifests")
        if not self._fs().exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs().listStatus(folder)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """Each bucket's folder, below root, in a version, the last by default; empty buckets have none."""
        known = self.versions()
        if not known:
            return {}
        stream = self._fs().open(self._path(f"manifests/v{known[-1] if version is None else version:09d}"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if found["n_buckets"] != self.n_buckets:
            raise ValueError(f"{self.root} has {found['n_buckets']} buckets, not {self.n_buckets}")
        return {int(b): path for b, path in found["buckets"].items()}

    def bucket(self, id_col: Column) -> Column:
        return F.pmod(F.xxhash64(id_col), F.lit(self.n_buckets)).cast("int")

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The state, or some buckets of it: other buckets' files aren't listed, let alone read."""
        found = self.manifest(version)
        paths = sorted({f"{self.root}/{path}" for b, path in found.items() if buckets is None or b in set(buckets)})
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def current(self) -> DataFrame:
        """The records that aren't deleted."""
        return self.read().where(F.col("estado_carga") != DELETED)

    def stage(self, batch: DataFrame, delete_missing: bool = True, revive_unchanged: bool = False) -> Draft:
        """Merges a batch (with seq) as cdc.merge does, and writes the buckets where something changes. batch is read twice."""
        version, before = (self.versions() or [0])[-1] + 1, self.manifest()
        narrow = merge(batch.select(*NARROW[:4], "seq"), self.read().select(*NARROW), delete_missing=delete_missing, revive_unchanged=revive_unchanged, mark="tocado")
        per_bucket = narrow.groupBy(self.bucket(F.col("id_registro")).alias("b")).agg(F.max("tocado").alias("tocado"), *[F.sum(c).alias(c) for c in COUNTS]).collect()  # one row a bucket
        counts = {c: sum(r[c] for r in per_bucket) for c in COUNTS}
        touched = sorted(r["b"] for r in per_bucket if r["tocado"])
        if not touched:
            return Draft(version, before, [], counts)
        own = batch.where(self.bucket(F.col("id_registro")).isin(touched))
        merged = merge(own, self.read(touched), delete_missing=delete_missing, revive_unchanged=revive_unchanged, seen=batch.select("fuente").distinct()).drop(*COUNTS)
        return Draft(version, before | self._write(merged, len(touched)), touched, counts)

    def _write(self, rows: DataFrame, n: int) -> dict[int, str]:
        """Rows of n buckets in a new folder: each bucket's."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.withColumn("bucket", self.bucket(F.col("id_registro"))).repartition(n, "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        names = [f.getPath().getName() for f in self._fs().listStatus(self._path(folder)) if f.isDirectory()]
        return {int(name.removeprefix("bucket=")): f"{folder}/{name}" for name in names}

    def replace(self, rows: DataFrame) -> Draft:
        """Rows as they are as the next version, for a first load."""
        buckets = self._write(rows, self.n_buckets)
        draft = Draft((self.versions() or [0])[-1] + 1, buckets, sorted(buckets), dict.fromkeys(COUNTS, 0))
        self.publish(draft)
        return draft

    def rows(self, draft: Draft, changed_only: bool = False) -> DataFrame:
        """The rows of a draft's touched buckets; changed_only: those that are new or have another hash than before."""
        paths = [f"{self.root}/{draft.buckets[b]}" for b in draft.touched]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        if not changed_only or not paths:
            return rows
        known = self.read(draft.touched, draft.version - 1).select("id_registro", F.col("hash_contenido").alias("__hash"), F.lit(True).alias("__known")) if draft.version > 1 else None
        if known is None:
            return rows
        both = rows.join(known, "id_registro", "left")
        return both.where(F.col("__known").isNull() | ~F.col("hash_contenido").eqNullSafe(F.col("__hash"))).drop("__hash", "__known")

    def publish(self, draft: Draft) -> int:
        """Makes the draft its version by one rename; fails if another merge took it (as surely as the file system renames)."""
        self._fs().mkdirs(self._path("manifests"))
        name = f"manifests/draft-{uuid.uuid4().hex}"
        out = self._fs().create(self._path(name), False)
        try:
            out.write(json.dumps({"n_buckets": self.n_buckets, "buckets": {str(b): p for b, p in sorted(draft.buckets.items())}}).encode())
        finally:
            out.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._path(name), self._path(f"manifests/v{draft.version:09d}"), none)
        except Exception as e:
            self._fs().delete(self._path(name), False)
            raise RuntimeError(f"version {draft.version} of {self.root} was taken") from e
        return draft.version

    def merge(self, batch: DataFrame, **how) -> Draft:
        """stage and publish; a batch that changes nothing makes no version."""
        draft = self.stage(batch, **how)
        if draft.touched:
            self.publish(draft)
        return draft

    def vacuum(self, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
        """Deletes manifests before the last `keep`, and folders of merges that no kept version names and that are older
        than the grace, which drafts of running merges and readers of older versions need. The folders that went."""
        known = self.versions()
        for v in known[: max(0, len(known) - keep)]:
            self._fs().delete(self._path(f"manifests/v{v:09d}"), False)
        named = {path for v in known[-keep:] for path in self.manifest(v).values()}
        gone, limit = [], (time.time() - grace_seconds) * 1000
        if self._fs().exists(self._path("data")):
            for merge_folder in self._fs().listStatus(self._path("data")):
                for f in self._fs().listStatus(merge_folder.getPath()):
                    name = f"data/{merge_folder.getPath().getName()}/{f.getPath().getName()}"
                    if f.isDirectory() and name not in named and f.getModificationTime() <= limit:
                        self._fs().delete(f.getPath(), True)
                        gone.append(name)
        return sorted(gone)
