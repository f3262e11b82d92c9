"""Shared pieces: tables, written intermediate tables, joins that survive hot groups, and ranks without hot tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..packaging import ship  # noqa: F401

#: A side is broadcast only if it has at most this many (narrow) rows; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
#: Words of 64 bits of a broadcast filter at most, and keys that such a filter still tells apart well (4 bits set for each).
FILTER_WORDS, FILTER_KEYS = 1 << 20, 1 << 24
#: A group is hot from this share of all rows on, so there are at most 1 / HOT_SHARE hot groups.
HOT_SHARE = 0.001
HOT_LEAST = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir where it is set, else, on one machine alone, a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        # The setting can't be changed in a running session, so the context remembers the folder.
        path = context._vigil_shared = getattr(context, "_vigil_shared", None) or tempfile.mkdtemp(prefix="vigil-shared-")
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/vigil/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """df, written once as Parquet to the shared folder: cuts lineage, and outlives any executor."""
    return kept(df, name, compression)[0]


def kept(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """As written, with the table's path, for drop_table() once nothing reads it any more."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    spark.sparkContext._vigil_tables = [*getattr(spark.sparkContext, "_vigil_tables", []), path]
    return spark.read.schema(df.schema).parquet(path), path


def tables_since(spark: SparkSession, n: int = 0) -> list[str]:
    """The paths of the tables that this session has written, from the n-th on; those dropped meanwhile among them."""
    return getattr(spark.sparkContext, "_vigil_tables", [])[n:]


def drop_table(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def at_most(df: DataFrame, n: int) -> bool:
    """Whether df has at most n rows; reads no more than it needs."""
    return df.limit(n + 1).count() <= n


def checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows allow it; otherwise unchanged, so the join shuffles."""
    return F.broadcast(df) if at_most(df, rows) else df


def equal(left: str, right: str, columns: list[str]) -> Column:
    """Whether all columns of the frames aliased left and right agree, nulls with nulls."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


class Filter:
    """A Bloom filter over rows of keys, in DataFrame functions: a broadcast table of 64-bit words, at most FILTER_WORDS.

    A key sets four bits of one word. With at most 16 keys a word about one row in 200 passes wrongly; no key is missed.
    """

    def __init__(self, keys: DataFrame, n: int):
        self.words = 1 << max(4, min(FILTER_WORDS, n // 4).bit_length())
        marks = keys.select(self._word([F.col(c) for c in keys.columns]).alias("word"), self._mask([F.col(c) for c in keys.columns]).alias("mask"))
        self.table = written(marks.groupBy("word").agg(F.bit_or("mask").alias("bits")), "filter")

    def _word(self, key: list[Column]) -> Column:
        return F.pmod(F.xxhash64(F.lit(104_729), *key), F.lit(self.words))

    @staticmethod
    def _mask(key: list[Column]) -> Column:
        h = F.xxhash64(F.lit(1_299_709), *key)
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
        return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])

    def joined(self, df: DataFrame, key: list[Column], name: str) -> DataFrame:
        """df with the filter's words, aliased name, beside its columns."""
        return df.join(F.broadcast(self.table.alias(name)), self._word(key) == F.col(f"{name}.word"), "left")

    def passes(self, key: list[Column], name: str) -> Column:
        """False where the key is certainly none of the filter's."""
        mask = self._mask(key)
        return F.coalesce(F.col(f"{name}.bits").bitwiseAND(mask) == mask, F.lit(False))


def lacking(source: DataFrame, rows: DataFrame, skip: DataFrame) -> DataFrame:
    """source without the rows whose keys, the columns of skip, are in skip; no row of source moves for up to FILTER_KEYS
    keys. rows: the keys of source, a narrow table. Where skip isn't small enough to broadcast, a row in tens of
    thousands may stay that is in skip; none goes that isn't."""
    columns, n = skip.columns, skip.count()
    if n <= BROADCAST_ROWS or n > FILTER_KEYS:
        few = F.broadcast(skip) if n <= BROADCAST_ROWS else skip
        return source.alias("s").join(few.alias("g"), equal("s", "g", columns), "left_anti")
    key = [F.col(f"s.{c}") for c in columns]
    first = Filter(skip, n)
    passing = first.joined(rows.select(*columns).alias("s"), key, "f").where(first.passes(key, "f")).select("s.*")
    wrongly = written(passing.alias("s").join(skip.alias("g"), equal("s", "g", columns), "left_anti").distinct(), "filter-wrongly")
    second = Filter(wrongly, wrongly.count())
    both = second.joined(first.joined(source.alias("s"), key, "f"), key, "w")
    return both.where(~first.passes(key, "f") | second.passes(key, "w")).select("s.*")


def holding(source: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of source whose keys, the columns of keys, are in keys. No row moves; where keys isn't small enough to
    broadcast, a row in 200 stays that isn't in keys, and beyond FILTER_KEYS keys all stay."""
    columns, n = keys.columns, keys.count()
    if n <= BROADCAST_ROWS:
        return source.alias("s").join(F.broadcast(keys).alias("k"), equal("s", "k", columns), "left_semi")
    if n > FILTER_KEYS:
        return source
    found, key = Filter(keys, n), [F.col(f"s.{c}") for c in columns]
    return found.joined(source.alias("s"), key, "f").where(found.passes(key, "f")).select("s.*")


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows inner-joined with groups on key, where groups has one row a key and its number of rows in `size`.

    Hot groups (at most 1 / HOT_SHARE of them, whatever the data) are broadcast, so their rows don't move; the rest
    is an ordinary equi-join. rows should be a written table: it is read twice.
    """
    least = max(HOT_LEAST, int(total * HOT_SHARE))
    hot = groups.where(F.col(size) >= least)
    hot_keys = F.broadcast(hot.select(key))
    a = rows.join(F.broadcast(hot), key)
    b = rows.join(hot_keys, key, "left_anti").join(groups.where(F.col(size) < least), key)
    return a.unionByName(b)


def mark(*cols: str) -> Column:
    """A number from 0 to 2^60 - 1 that mixes the values of cols: the first 15 hexadecimal digits of the MD5 of their text."""
    values = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(values), 1, 15), 16, 10).cast("long")


def rank_within(df: DataFrame, key: list[str], order: list[str], rows_per_bucket: int = 50_000, out: str = "rank") -> DataFrame:
    """df with a rank from 0 within key, gapless, and `<out>_of`, the key's number of rows.

    The order within a key is by mark(order), then order. Ranges of marks are buckets: rows are numbered within each, and
    shifted by the counts of the buckets before; so a key with a third of all rows still spreads over many tasks. df
    should be a written table: it is read twice.
    """
    largest, total = df.groupBy(*key).count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    n, bucket = 1, max(200, min(rows_per_bucket, total // 400))
    while n * bucket < largest:
        n *= 2
    dealt = df.withColumn("__mark", mark(*order)).withColumn("__bucket", F.floor(F.col("__mark") / ((1 << 60) // n)).cast("int"))
    counts = dealt.groupBy(*key, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    per_key = Window.partitionBy(*key)
    shifts = counts.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col("__bucket").alias("__kb"),
        F.coalesce(F.sum("__n").over(per_key.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__shift"),
        F.sum("__n").over(per_key).alias(f"{out}_of"),
    )
    numbered = dealt.withColumn("__in", F.row_number().over(Window.partitionBy(*key, "__bucket").orderBy("__mark", *order)) - 1)
    same = F.col("__bucket") == F.col("__kb")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = numbered.join(checked(shifts), same)
    drop = ["__mark", "__bucket", "__kb", "__in", "__shift", *[f"__k{i}" for i in range(len(key))]]
    return joined.withColumn(out, (F.col("__shift") + F.col("__in")).cast("long")).drop(*drop)


def totals_before(df: DataFrame, bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """df with `out`, the sum of value over the rows before it in the order of (bucket, order).

    Rows are summed up within their buckets, in as many tasks as there are buckets; only the buckets' own sums, one row
    each, are summed up in one. df should be a written table: it is read twice.
    """
    own = F.coalesce(F.sum(value).over(Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = df.groupBy(F.col(bucket).alias("__bucket")).agg(F.sum(value).alias("__sum"))
    starts = sums.select("__bucket", F.coalesce(F.sum("__sum").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    return df.withColumn(out, own).join(checked(starts), F.col(bucket) == F.col("__bucket")).withColumn(out, F.col(out) + F.col("__start")).drop("__bucket", "__start")


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list of longs: rows (node, root), root the smallest node of the component.

    Large-star and small-star rounds until the links stop changing; each round is a written table, so lineage stays
    short. Rounds grow with the logarithm of the longest path. Nodes without an edge are not returned.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e, path = kept(e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")

    def mark(x: DataFrame):
        return x.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.lit(0))).first()

    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
        # A node with very many links is the centre of a star; such centres are few, so they are broadcast.
        large = attach_groups(both.where(F.col("v") > F.col("u")), least, "u", "n", 2 * before[0]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        small = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        old = path
        e, path = kept(small.where("u <> v").distinct(), "edges")
        drop_table(edges.sparkSession, old)
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
