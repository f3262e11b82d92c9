"""Approximate nearest neighbours by inner product: cross-polytope hashing, multiprobe tables, exact reranking.

A hash turns a unit vector by fast Hadamard pseudo-rotations (three rounds of random signs and a Walsh-Hadamard
transform) and takes the signed axis nearest to it; a bucket is the axes of one or more such hashes. Every vector is in
one bucket of every table. A query probes, in every table, the buckets whose axes lose least against its own nearest
ones. What it meets there is scored exactly.

Equal vectors are searched once: the index holds distinct vectors with the k + 1 smallest ids of each, which are all
that a result of k rows without the query's own can need. Vectors and queries meet by bucket in tiles of at most TILE
vectors and BLOCK queries; buckets with more are dealt over several, so no task holds a hot bucket. A tile gives each
of its queries' k + 1 best vectors, so candidate pairs never become rows.

The number of tables, hashes a bucket and probes is measured, whatever the data: for at most SAMPLE queries of each
dimension the true neighbours are found by one scan, and the cheapest plan is taken whose probes hold the stated share
of them (`recall`; with one hash a bucket, all buckets are few, so that share is always reached). Probing goes by direction;
where lengths differ much, more probes are needed, and the measurement sees to that. Queries that find fewer than k
rows are compared with all vectors, in the same tiles.

Defined cases: rows with a null id, and vectors null, empty, zero or holding a null or non-finite component take no
part; vectors are compared with those of the same dimension; repeated rows count once; if an id has several vectors,
each is a query and a candidate of its own; ties go to the smaller id; fewer candidates than k give fewer rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_groups, checked, ship, written

#: Vectors and queries that meet in one task at most.
TILE, BLOCK = 4096, 2048
#: Queries of each dimension on which the plan is measured at most.
SAMPLE = 64
#: Probes of a table at most, where a bucket has several hashes.
MOST_PROBES = 4096
#: Moving a row costs as much as scoring so many vectors.
ROW_COST = 200
TABLES = (2, 4, 8)
#: Scores compared beside the k + 1 best, so that rounding in the first pass drops none.
SPARE = 8


def padded(dim: int) -> int:
    return max(2, 1 << (dim - 1).bit_length())


@cache
def signs(dim: int, turn: int) -> np.ndarray:
    return np.random.default_rng((12, dim, turn)).integers(0, 2, (3, padded(dim))) * 2.0 - 1.0


def rotated(x: np.ndarray, turn: int) -> np.ndarray:
    """Rows of x, as unit vectors, under the turn-th pseudo-rotation; zeros fill up to a power of two."""
    n, dim = x.shape
    size = padded(dim)
    y = np.zeros((n, size))
    y[:, :dim] = x / np.abs(x).max(axis=1, keepdims=True)
    y /= np.sqrt((y * y).sum(axis=1, keepdims=True))
    for s in signs(dim, turn):
        y = y * s
        half = 1
        while half < size:
            y = y.reshape(n, -1, 2, half)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
            half *= 2
        y /= math.sqrt(size)
    return y


def signed(x: np.ndarray, turn: int) -> np.ndarray:
    """The product of each row with every signed axis: the axes, then their opposites."""
    y = rotated(x, turn)
    return np.concatenate([y, -y], axis=1)


def buckets(x: np.ndarray, table: int, hashes: int) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for h in range(hashes):
        v = signed(x, table * 8 + h)
        out = out * v.shape[1] + v.argmax(axis=1)
    return out


def probes(x: np.ndarray, table: int, hashes: int, n: int) -> np.ndarray:
    """For each row the n buckets of a table that lose least, best first."""
    best = np.zeros((len(x), 1), np.int64)
    loss = np.zeros((len(x), 1))
    for h in range(hashes):
        v = signed(x, table * 8 + h)
        lost = (v.max(axis=1, keepdims=True) - v) ** 2
        axes = np.argsort(lost, axis=1, kind="stable")[:, :n]
        sums = (loss[:, :, None] + np.take_along_axis(lost, axes, 1)[:, None, :]).reshape(len(x), -1)
        codes = (best[:, :, None] * v.shape[1] + axes[:, None, :]).reshape(len(x), -1)
        order = np.argsort(sums, axis=1, kind="stable")[:, :n]
        best, loss = np.take_along_axis(codes, order, 1), np.take_along_axis(sums, order, 1)
    return best


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(-1, dim)


def by_dimension(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch's rows by dimension, at most `most` at once."""
    lengths = pc.list_value_length(batch["vec"])
    for dim in pc.unique(lengths).to_pylist():
        rows = batch.filter(pc.equal(lengths, dim))
        for i in range(0, len(rows), most):
            yield dim, rows.slice(i, most)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, in double precision; the same for the same two vectors wherever they meet."""
    return (q * x).sum(axis=-1)


def best(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of q the places of its k best rows of x, and their scores; ties to the smaller first."""
    out = []
    k, largest = min(k, len(x)), np.abs(x).max()
    for i in range(0, len(q), 128):
        part = q[i : i + 128]
        rough = part @ x.T
        n = min(len(x), k + SPARE)
        near = np.argpartition(-rough, n - 1, axis=1)[:, :n] if n < len(x) else np.broadcast_to(np.arange(n), (len(part), n))
        fine = exact(part[:, None, :], x[near])
        for j in range(len(part)):
            places, scores = near[j], fine[j]
            kth = np.partition(scores, n - k)[n - k]
            slack = 1e-12 * np.abs(part[j]).sum() * largest
            if n < len(x) and rough[j, places].min() >= kth - slack:  # as good ones may be left
                places = np.flatnonzero(rough[j] >= kth - slack)
                scores = exact(part[j][None, :], x[places])
            order = np.lexsort((first[places], -scores))[:k]
            out.append((places[order], scores[order]))
    return out


def _number_type(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType
    return "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, key, vec) that take part; key tells vectors apart."""
    vec = F.col("vec")
    plain = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{_number_type(df, vector_col)}>").alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    key = F.concat_ws(".", F.xxhash64(F.lit(1), vec), F.xxhash64(F.lit(2), vec))
    # A negative zero is a zero.
    return rows.where(plain).withColumn("vec", F.transform(vec, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))).select("id", key.alias("key"), "vec")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """One row for each vector: num, key, vec, ids (the k + 1 smallest)."""
    least = rows.select("key", "id").distinct().withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("n") <= k + 1)
    ids = least.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return written(rows.select("key", "vec").distinct().join(ids, "key").select(F.monotonically_increasing_id().alias("num"), "key", "vec", "ids"), "vectors")


def _plan(vectors: DataFrame, queries: DataFrame, k: int, recall: float) -> dict[int, tuple[int, int, int]]:
    """For each dimension: tables, hashes a bucket, probes a table."""
    sizes = {r[0]: r[1] for r in vectors.groupBy(F.size("vec")).count().collect()}
    asked = {r[0]: r[1] for r in queries.groupBy(F.size("vec")).count().collect()}
    pick = Window.partitionBy(F.size("vec")).orderBy(F.xxhash64("key"), "key")
    sample: dict[int, list] = {}
    for r in queries.withColumn("n", F.row_number().over(pick)).where(F.col("n") <= SAMPLE).select("key", "vec").collect():
        sample.setdefault(len(r.vec), []).append((r.key, np.asarray(r.vec, dtype=np.float64)))
    own = {dim: {key: i for i, (key, _) in enumerate(rows)} for dim, rows in sample.items()}
    asking = {dim: np.array([v for _, v in rows]) for dim, rows in sample.items()}

    def nearest_of_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for dim, rows in by_dimension(batch, TILE):
                if dim not in asking:
                    continue
                x, keys = matrix(rows["vec"], dim), rows["key"].to_pylist()
                mine = {own[dim][key]: i for i, key in enumerate(keys) if key in own[dim]}
                for j, (places, scores) in enumerate(best(asking[dim], x, np.arange(len(x)), k + 1)):
                    got = [(s, x[p]) for p, s in zip(places, scores) if mine.get(j) != p]
                    found[dim, j] = sorted([*found.get((dim, j), []), *got], key=lambda a: -a[0])[:k]
        rows = [(dim, j, s, v.tolist()) for (dim, j), got in found.items() for s, v in got]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64())))] if rows else [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()))], names=["dim", "j", "score", "vec"])

    top = Window.partitionBy("dim", "j").orderBy(F.desc("score"))
    rows = vectors.select("key", "vec").mapInArrow(nearest_of_sample, "dim int, j int, score double, vec array<double>")
    true: dict[int, list] = {}
    for r in rows.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k).select("dim", "j", "vec").collect():
        true.setdefault(r.dim, []).append((r.j, np.asarray(r.vec)))
    return {dim: cheapest(asking[dim], true.get(dim, []), sizes.get(dim, 0), asked[dim], recall) for dim in asking}


def cheapest(asking: np.ndarray, true: list[tuple[int, np.ndarray]], size: int, asked: int, recall: float) -> tuple[int, int, int]:
    """The plan of least cost whose probes reach the share `recall` of the pairs (row of asking, neighbour)."""
    dim, best_plan = asking.shape[1], (math.inf, (TABLES[0], 1, 1))
    if not true:
        return best_plan[1]
    who, neighbours = np.array([j for j, _ in true]), np.array([v for _, v in true])
    axes = 2 * padded(dim)
    for hashes in range(1, min(7, max(1, round(math.log(max(size, 2), axes)))) + 1):
        n = axes if hashes == 1 else MOST_PROBES
        at = np.empty((TABLES[-1], len(who)), np.int64)
        for table in range(TABLES[-1]):
            order, codes = probes(asking, table, hashes, n), buckets(neighbours, table, hashes)
            hit = order[who] == codes[:, None]
            at[table] = np.where(hit.any(axis=1), hit.argmax(axis=1), n)
        for tables in TABLES:
            needed = int(np.sort(at[:tables].min(axis=0))[max(0, math.ceil(recall * len(who)) - 1)]) + 1
            if needed <= n:
                cost = tables * needed * (size / axes**hashes + ROW_COST) + ROW_COST * tables * size / max(1, asked)
                best_plan = min(best_plan, (cost, (tables, hashes, needed)))
    return best_plan[1]


PLACED = "dim int, tab int, bucket long, num long, first_id long"


def _placed(vectors: DataFrame, plan: dict, probing: bool) -> DataFrame:
    """A row for each table (and probe): dim, tab, bucket, num, first_id, vec."""
    kind = vectors.schema["vec"].dataType.elementType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in set(pc.unique(pc.list_value_length(batch["vec"])).to_pylist()) & set(plan):
                tables, hashes, n = plan[dim]
                many = max(1, 20_000 // (tables * n)) if probing else 5_000
                for d, rows in by_dimension(batch, many):
                    if d != dim:
                        continue
                    x = matrix(rows["vec"], dim)
                    for table in range(tables):
                        codes = probes(x, table, hashes, n) if probing else buckets(x, table, hashes)[:, None]
                        rep = rows.take(pa.array(np.repeat(np.arange(len(x)), codes.shape[1])))
                        same = [pa.array(np.full(len(rep), v, np.int32)) for v in (dim, table)]
                        yield pa.RecordBatch.from_arrays([*same, pa.array(codes.ravel()), rep["num"], rep["first_id"], rep["vec"]], names=["dim", "tab", "bucket", "num", "first_id", "vec"])

    return vectors.select("num", F.col("ids")[0].alias("first_id"), "vec").mapInArrow(place, f"{PLACED}, vec array<{kind}>")


def _scored(members: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Rows (qid, num, first_id, score): the k best distinct vectors that each query meets in each tile."""
    place = ["dim", "tab", "bucket"]
    met = members.select(*place, F.lit(1).alias("m"), F.lit(0).alias("q")).unionByName(queries.select(*place, F.lit(0).alias("m"), F.lit(1).alias("q")))
    counts = met.groupBy(*place).agg(F.sum("m").alias("m"), F.sum("q").alias("q")).where((F.col("m") > TILE) | (F.col("q") > BLOCK))
    large = checked(written(counts.select(*place, F.ceil(F.col("m") / TILE).alias("tiles"), F.ceil(F.col("q") / BLOCK).alias("blocks")), "large-buckets"))

    def dealt(df: DataFrame, own: str, others: str, role: int) -> DataFrame:
        n_own, n_others = F.coalesce(F.col(f"{own}s"), F.lit(1)), F.greatest(F.lit(1), F.coalesce(F.col(f"{others}s"), F.lit(1)))
        rows = df.join(large, place, "left").withColumn(own, F.pmod(F.xxhash64("num"), F.greatest(F.lit(1), n_own))).withColumn(others, F.explode(F.sequence(F.lit(0).cast("long"), n_others.cast("long") - 1)))
        return rows.select(*place, "tile", "block", F.lit(role).alias("role"), "num", "first_id", "vec")

    def score(group: pa.Table) -> pa.Table:
        role = np.asarray(group["role"])
        m, q = group.filter(pa.array(role == 0)), group.filter(pa.array(role == 1))
        columns: list = [[], [], [], []]
        if len(m) and len(q):
            dim = group["dim"][0].as_py()
            x, first, num, qid = matrix(m["vec"].combine_chunks(), dim), np.asarray(m["first_id"]), np.asarray(m["num"]), np.asarray(q["num"])
            for i, (places, scores) in enumerate(best(matrix(q["vec"].combine_chunks(), dim), x, first, k)):
                for c, v in zip(columns, (np.full(len(places), qid[i]), num[places], first[places], scores)):
                    c.append(v)
        kinds = (np.int64, np.int64, np.int64, np.float64)
        return pa.table([np.concatenate(c) if c else np.array([], t) for c, t in zip(columns, kinds)], names=["qid", "num", "first_id", "score"])

    both = dealt(members, "tile", "block", 0).unionByName(dealt(queries, "block", "tile", 1))
    return both.groupBy(*place, "tile", "block").applyInArrow(score, "qid long, num long, first_id long, score double")


def _everywhere(vectors: DataFrame) -> DataFrame:
    """All vectors of a dimension in one bucket."""
    return vectors.select(F.size("vec").alias("dim"), F.lit(0).alias("tab"), F.lit(0).cast("long").alias("bucket"), "num", F.col("ids")[0].alias("first_id"), "vec")


def _best_rows(scored: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """For each qid its k + 1 best rows, best first, as an array `near` of (n, score, id, key)."""
    # The same vector, met in several tables, has the same score, so equal ranks are one vector.
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "first_id", "num")
    few = scored.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= k + 1).groupBy("qid", "num").agg(F.max("score").alias("score"))
    rows = few.join(vectors.select("num", "key", "ids"), "num").select("qid", "score", "key", F.explode("ids").alias("id"))
    last = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return rows.withColumn("n", F.row_number().over(last)).where(F.col("n") <= k + 1).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("n", "score", "id", "key"))).alias("near"))


def nearest(base: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.97) -> DataFrame:
    """Rows (query_id, rank from 1, vec_id, score): for each row of queries the k rows of base of largest inner product that were found."""
    spark = base.sparkSession
    ship(spark)
    asked = usable(queries, id_col, vector_col).distinct()
    vectors, wanted = distinct_vectors(usable(base, id_col, vector_col), k), distinct_vectors(asked, k)
    plan = _plan(vectors, wanted, k, recall)
    near = written(_best_rows(_scored(_placed(vectors, plan, False), _placed(wanted, plan, True), k + 1), vectors, k), "near")
    # Queries that found too few, though there are more, meet all vectors.
    there = vectors.groupBy(F.size("vec").alias("dim")).agg(F.sum(F.size("ids")).alias("there"))
    few = wanted.select("num", "key", "vec", "ids", F.size("vec").alias("dim")).join(near.select(F.col("qid").alias("num"), F.size("near").alias("got")), "num", "left").join(checked(there), "dim")
    few = written(few.where(F.coalesce(F.col("got"), F.lit(0)) < F.least(F.lit(k + 1).cast("long"), F.col("there"))).select("num", "key", "vec", "ids"), "few")
    if not few.isEmpty():
        again = _best_rows(_scored(_everywhere(vectors), _everywhere(few), k + 1), vectors, k)
        near = written(near.join(few.select(F.col("num").alias("qid")), "qid", "left_anti").unionByName(again), "near-all")
    rows = written(asked.select(F.col("id").alias("query_id"), "key"), "asked")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_queries"))
    groups = sizes.join(wanted.select(F.col("num").alias("qid"), "key"), "key").join(near, "qid").select("key", "n_queries", "near")
    joined = attach_groups(rows, groups, "key", "n_queries", rows.count())
    others: Column = F.slice(F.filter("near", lambda x: (x["id"] != F.col("query_id")) | (x["key"] != F.col("key"))), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("place", "one")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.id").alias("vec_id"), F.col("one.score").alias("score"))
