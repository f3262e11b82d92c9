"""A store of immutable Parquet shards with size-tiered compaction and atomically committed, versioned manifests.

    <root>/data/run-<version>-<random>/part-*.parquet      immutable shards
    <root>/manifests/v<version>.json                       which runs make up that version

append() writes an arrival as a run of small shards and commits a manifest that adds it. compact() looks for a size
tier (powers of `fan` of the tier base) that holds at least `fan` runs, merges them into one run of target-sized files
and commits a manifest with that run in place of the old ones; it repeats until no tier is full. Merging similar sizes
writes a row at most once a tier, and leaves at most fan - 1 runs a tier: the manifest grows with the logarithm of the
data, not with the data. Rows move without a shuffle: whole shards are read and written again, several to a file.

A change is built on one version and committed as the next by renaming a finished file to its name, which fails if
another writer took that version. The loser reads the new version and adds its run to that; a merge whose runs are no
longer all there is given up and planned anew. Readers see one manifest, so one whole state. The rename must be atomic
where several writers commit at the same moment: it is on HDFS and its like; local disks and object stores only check
before they rename, so there one writer at a time must commit. Lost executors cost a task's retry; a lost driver leaves
an unreferenced run, which vacuum() removes.

Defined cases: an empty arrival is committed as a run without rows; nulls, long texts, repeated rows and any further
columns are kept as they are; arrivals must have the columns of the first; reading an empty store raises ValueError.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ManifestConflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class Run:
    path: str
    bytes: int
    files: int


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fan: int = 4, tier_base: int = 1 << 20):
        self.spark, self.root, self.target, self.fan, self.base = spark, root.rstrip("/"), target_bytes, fan, tier_base

    # Files, through Hadoop's file systems, so any store that Spark reads will do.

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _measure(self, path: str) -> Run:
        found = [f for f in self._fs().listStatus(self._path(path)) if f.getPath().getName().endswith(".parquet")]
        return Run(path, sum(f.getLen() for f in found), len(found))

    # Manifests

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        if not self._fs().exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs().listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def runs(self, version: int | None = None) -> list[Run]:
        """The runs of a version, of the latest by default; none in an empty store (version 0)."""
        version = self.latest() if version is None else version
        if not version:
            return []
        stream = self._fs().open(self._path(self._manifest(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Run(**r) for r in json.loads(text)["runs"]]

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/v{version:012d}.json"

    def _commit(self, version: int, runs: list[Run]) -> int:
        draft, final = self._path(f"{self.root}/manifests/.draft-{uuid.uuid4().hex}"), self._path(self._manifest(version))
        out = self._fs().create(draft, True)
        out.write(json.dumps({"version": version, "time": time.time(), "runs": [asdict(r) for r in runs]}).encode())
        out.close()
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else self._fs().getUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, final, none)
        except Exception as e:
            self._fs().delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise ManifestConflict(f"version {version} exists") from e
            raise
        return version

    def latest(self) -> int:
        return (self.versions() or [0])[-1]

    def _add(self, run: Run) -> int:
        """Commits the latest version with a run more."""
        while True:
            before = self.latest()
            try:
                return self._commit(before + 1, [*self.runs(before), run])
            except ManifestConflict:  # another writer was faster: on top of that version, then
                continue

    # Rows

    def _run_path(self, version: int) -> str:
        return f"{self.root}/data/run-{version:012d}-{uuid.uuid4().hex}"

    def _write(self, df: DataFrame, version: int, codec: str) -> Run:
        path = self._run_path(version)
        df.write.option("compression", codec).parquet(path)
        return self._measure(path)

    def append(self, df: DataFrame) -> int:
        """Adds an arrival; returns the new version."""
        return self._add(self._write(df, self.latest() + 1, "snappy"))

    def append_split(self, df: DataFrame, n: int, by: list[str]) -> Iterator[int]:
        """Adds df as n arrivals, dealt by a hash of the columns `by`: written in one job, each committed when it is asked for."""
        name = "arrival"
        while name in df.columns:
            name += "_"
        path = f"{self.root}/incoming/{uuid.uuid4().hex}"
        df.withColumn(name, F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")).write.partitionBy(name).option("compression", "snappy").parquet(path)
        parts = sorted(f.getPath().getName() for f in self._fs().listStatus(self._path(path)) if f.isDirectory())
        if not parts:
            yield self.append(df)  # no row: an empty arrival that has the columns
        for part in parts:
            own = self._run_path(self.latest() + 1)
            self._fs().rename(self._path(f"{path}/{part}"), self._path(own))
            yield self._add(self._measure(own))
        self._fs().delete(self._path(path), True)

    def tier(self, run: Run) -> int:
        return max(0, math.floor(math.log(max(run.bytes, 1) / self.base, self.fan)))

    def compact(self) -> int:
        """Merges full tiers, smallest first, until there is none; returns the latest version."""
        while True:
            before = self.latest()
            runs = self.runs(before)
            tiers: dict[int, list[Run]] = {}
            for r in runs:
                tiers.setdefault(self.tier(r), []).append(r)
            full = min((t for t, own in tiers.items() if len(own) >= self.fan), default=None)
            if full is None:
                return before
            merged = tiers[full]
            files = max(1, round(sum(r.bytes for r in merged) / self.target))
            new = self._write(self._frame(merged).coalesce(files), before + 1, "zstd")
            while set(merged) <= set(runs):
                try:
                    self._commit(before + 1, [new if r == merged[0] else r for r in runs if r == merged[0] or r not in merged])
                    break
                except ManifestConflict:
                    before = self.latest()
                    runs = self.runs(before)
            else:  # another writer has merged some of them
                self._fs().delete(self._path(new.path), True)

    def _frame(self, runs: list[Run]) -> DataFrame:
        if not runs:
            raise ValueError("the store is empty")
        return self.spark.read.parquet(*[r.path for r in runs])

    def read(self, version: int | None = None) -> DataFrame:
        return self._frame(self.runs(version))

    def vacuum(self, keep: int = 2, grace_s: float = 86_400.0) -> int:
        """Deletes all but the last `keep` manifests, and runs that none of those names and that are older than
        grace_s, which must be longer than any write or read takes; returns how many runs went. Without a grace, the
        caller must be the store's only user."""
        known = self.versions()
        for v in known[: max(0, len(known) - keep)]:
            self._fs().delete(self._path(self._manifest(v)), False)
        named = {r.path.rsplit("/", 1)[-1] for v in known[-keep:] for r in self.runs(v)}
        gone = 0
        for name, least in (("data", grace_s), ("incoming", max(grace_s, 86_400.0))):
            folder = self._path(f"{self.root}/{name}")
            for f in self._fs().listStatus(folder) if self._fs().exists(folder) else ():
                if f.getPath().getName() not in named and time.time() - f.getModificationTime() / 1000 >= least:
                    gone += bool(self._fs().delete(f.getPath(), True))
        return gone


def placed(store: ShardStore, version: int | None = None) -> DataFrame:
    """row (a struct of the store's columns), run (the version that wrote it), shard (the file within the run) and
    shard_bytes of each row."""
    df = store.read(version)
    name = F.col("_metadata.file_path")
    run = F.regexp_extract(name, r"run-(\d{12})-[0-9a-f]{32}/part-\d+", 1).cast("long")
    shard = F.regexp_extract(name, r"run-\d{12}-[0-9a-f]{32}/part-(\d+)", 1).cast("int")
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), run.alias("run"), shard.alias("shard"), F.col("_metadata.file_size").alias("shard_bytes"))


def ingest(store: ShardStore, arrivals: Iterable[DataFrame | int], alone: bool = False) -> ShardStore:
    """Appends each arrival, if append_split() hasn't yet, and compacts after it. alone: nobody else uses the store, so
    what a merge has replaced goes at once; else vacuum() is for its keeper to call."""
    for arrival in arrivals:
        if isinstance(arrival, DataFrame):
            store.append(arrival)
        before = store.latest()
        if store.compact() != before and alone:
            store.vacuum(keep=1, grace_s=0.0)
    return store
