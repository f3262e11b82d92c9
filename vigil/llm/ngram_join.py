"""N-gram Jaccard self-join: MinHash candidates, Bayesian pruning, exact verification.

Texts are word shingles (5 words, similarity 0.8 by default). Equal texts are one class, represented once.
1. Each class gets MinHash values; bands of them put it into buckets. A bucket links its members to its least member
   (a star, so links grow with members, not pairs). Links whose values agree far too seldom are dropped, and connected
   components of the rest hold every pair that shares a bucket and comes near the threshold.
2. Components are cut into blocks, and each pair of blocks is one task of bounded size, also where one component has a
   third of all rows. In it all pairs are compared on more and more MinHash values; a pair is dropped as soon as the
   posterior probability of reaching the threshold, from a uniform prior, is below `tolerance`.
3. The pairs that remain are counted exactly on their shingle sets. Tasks return sums of links and spanning links.

The bands miss a pair at the threshold with probability (1 - 0.8^5)^24 < 1e-4, more similar ones far less often.

Defined cases: null text counts as empty; a text without words has no shingles and is linked to its equal copies only;
a text of fewer than 5 words is one shingle; null ids belong to classes but never name one that has another id; rows
repeated with the same id and text count as copies; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, checked, connected, holding, lacking, ship, written
from .exact_dedup import content_hash, without
from .words import chunks, constants, shingles, word_hashes

BANDS, ROWS = 24, 5
VALUES = 128
#: MinHash values compared before each pruning decision.
STEPS = (16, 32, 64, 128)
#: Stars whose ends agree in fewer values than this are dropped: similarity below 0.36, where 0.6 is the least that
#: two texts can have which are both within 0.8 of a third.
STAR_LEAST = 46
#: Texts and shingles of a block of a component; a task holds two blocks.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 500_000


def min_hashes(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values (texts x VALUES, int32) of texts with at least one shingle each."""
    flip, times = constants(VALUES, 37), constants(VALUES, 41)
    out = np.empty((len(counts), VALUES), np.uint32)
    ends = np.cumsum(counts)
    row = 0
    while row < len(counts):  # blocks that stay in the cache
        begin = ends[row] - counts[row]
        end = max(row + 1, int(np.searchsorted(ends, begin + 16_384, side="right")))
        own, at = flat[begin : ends[end - 1]], ends[row:end] - counts[row:end] - begin
        buffer = np.empty_like(own)
        for h in range(VALUES):
            np.bitwise_xor(own, flip[h], out=buffer)
            np.multiply(buffer, times[h], out=buffer)
            out[row:end, h] = np.minimum.reduceat(buffer, at) >> np.uint64(32)
        row = end
    return out.view(np.int32)


def _sketch(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch.column(1)):
                flat, counts = shingles(*word_hashes(data, offsets), k)
                some = np.flatnonzero(counts)
                if not len(some):
                    continue
                values = min_hashes(flat, counts[some])
                arrays = [
                    batch.column(0).take(pa.array(some + row)), pa.array(counts[some], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, VALUES), pa.int32()), pa.array(values.ravel(), pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "n", "values"])

    return run


def least_agreeing(threshold: float, tolerance: float, n: int) -> int:
    """The fewest of n equal MinHash values with a posterior probability of at least `tolerance` that the similarity
    is at least `threshold`: under a uniform prior, P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n + 1


def similar_pairs(sets: list[np.ndarray], side: np.ndarray | None, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with a similarity of at least threshold, between side 0 and side 1 or, without sides, of all.
    sets: sorted distinct shingle hashes, none empty."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values = min_hashes(np.concatenate(sets), sizes)
    if side is None:
        a, b = np.triu_indices(len(sets), 1)
    else:
        a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1), indexing="ij"))
    t = Fraction(threshold).limit_denominator(10_000)
    num, den = t.numerator, t.denominator
    fits = np.minimum(sizes[a], sizes[b]) * den >= num * np.maximum(sizes[a], sizes[b])
    a, b = a[fits], b[fits]
    agree, start = np.zeros(len(a), np.int64), 0
    for end in STEPS:
        for at in range(start, end, 16):
            agree += (values[a, at : at + 16] == values[b, at : at + 16]).sum(axis=1)
        stay = agree >= least_agreeing(threshold, tolerance, end)
        a, b, agree, start = a[stay], b[stay], agree[stay], end
    if not len(a):
        return a, b
    # Exact: mark the shingles of one text, count the marks of its partners.
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(ids, np.cumsum(sizes)[:-1])
    mark = np.zeros(int(ids.max()) + 1, dtype=np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    common = np.empty(len(a), np.int64)
    cuts = np.append(np.flatnonzero(np.diff(a, prepend=-1)), len(a))
    for begin, end in zip(cuts[:-1], cuts[1:]):
        mark[own[a[begin]]] = 1
        partners = b[begin:end]
        at = np.cumsum(sizes[partners]) - sizes[partners]
        common[begin:end] = np.add.reduceat(mark[np.concatenate([own[p] for p in partners])], at)
        mark[own[a[begin]]] = 0
    true = common * den >= num * (sizes[a] + sizes[b] - common)
    return a[true], b[true]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each index's component."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return np.array([find(x) for x in range(n)])


def _verify(k: int, threshold: float, tolerance: float) -> Callable[[pa.Table], pa.Table]:
    def run(tile: pa.Table) -> pa.Table:
        within = tile["i"][0].as_py() == tile["j"][0].as_py()
        at = {node: row for row, node in enumerate(tile["node"].to_pylist())}  # a node's last row, if it has several
        nodes = sorted(at)
        tile = tile.take(pa.array([at[node] for node in nodes], pa.int64()))
        sets: list[np.ndarray] = []
        for _, data, offsets in chunks(tile["text"].combine_chunks()):
            flat, counts = shingles(*word_hashes(data, offsets), k)
            sets += [np.unique(x) for x in np.split(flat, np.cumsum(counts)[:-1])]
        a, b = similar_pairs(sets, None if within else np.asarray(tile["side"]), threshold, tolerance)
        weight, links = np.asarray(tile["copies"]), np.zeros(len(nodes), np.int64)
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        some = np.flatnonzero(links)
        root = roots(len(nodes), a, b)
        return pa.table({"node": pa.array([nodes[x] for x in some], pa.binary()), "root": pa.array([nodes[root[x]] for x in some], pa.binary()), "links": pa.array(links[some])})

    return run


def ngram_join(docs: DataFrame, words: int = 5, threshold: float = 0.8, tolerance: float = 1e-4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, cluster_id (least id of the connected texts), n_links (rows of equal text or
    of a similarity of at least threshold, without itself), copies (rows of equal text) and text_hash."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("node", content_hash(F.col("text")))
    rows = written(source.select("doc_id", "node"), "join-rows")
    classes = written(rows.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")), "join-classes")
    n_rows, n_classes = rows.count(), classes.count()
    # One row of each class is sketched; a few copies may be again, with the same sketch.
    again = attach_groups(rows, classes.where("copies > 1"), "node", "copies", n_rows).where(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "doc_id").distinct()
    first = lacking(source, rows, written(again, "join-copies"))
    sketches = first.select("node", "text").mapInArrow(_sketch(words), "node binary, n long, `values` array<int>")
    sketches = written(sketches, "join-sketches")
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("values", i * ROWS + 1, ROWS)))
    members = sketches.select("node", F.explode(band).alias("bucket"))
    stars = members.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("other"), F.count(F.lit(1)).alias("members")).where("center <> other").select("bucket", "center", "members")
    stars = written(stars, "join-stars")
    # A bucket may hold a third of all texts, and be so in every band: such buckets, BANDS / HOT_SHARE at most, are broadcast.
    links = attach_groups(members, stars, "bucket", "members", n_classes).where("node <> center").select("node", "center")
    links = written(links.distinct(), "join-links")
    ends = links.select("node").unionByName(links.select(F.col("center").alias("node"))).distinct()
    ends = written(sketches.join(checked(ends), "node", "left_semi").dropDuplicates(["node"]), "join-ends")
    of_node = written(links.join(ends.select("node", F.col("values").alias("__a")), "node"), "join-sketched-links")
    n_links = links.groupBy("center").agg(F.count(F.lit(1)).alias("links"))
    of_center = written(n_links.join(ends.select(F.col("node").alias("center"), "values"), "center"), "join-centers")
    both = attach_groups(of_node, of_center, "center", "links", links.count())
    agreeing = F.size(F.filter(F.zip_with("__a", "values", lambda x, y: x == y), lambda x: x))
    coarse = connected(both.where(agreeing >= STAR_LEAST).select(F.col("node").alias("a"), F.col("center").alias("b")))
    parts = written(coarse.join(ends.select("node", "n"), "node").join(classes, "node"), "join-parts")
    size = parts.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("texts"))
    size = written(size, "join-sizes")
    block = F.pmod(F.xxhash64(F.lit(5), "node"), F.col("blocks")).cast("int").alias("block")
    blocked = written(attach_groups(parts, size, "root", "texts", parts.count()).select(F.col("node").alias("__node"), "copies", "first_id", "root", "blocks", block), "join-blocked")
    # The row that names the class brings its text, and goes to a tile for each block of its component.
    named = (F.col("node") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    texts = holding(source, blocked.select(F.col("__node").alias("node"), F.col("first_id").alias("doc_id")))
    tiles = texts.join(checked(blocked), named).select("node", "text", "copies", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    tiles = tiles.select(
        "root", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "node", "text", "copies",
        F.when(F.col("block") > F.col("with"), 1).otherwise(0).alias("side"),
    )
    found = tiles.groupBy("root", "i", "j").applyInArrow(_verify(words, threshold, tolerance), "node binary, root binary, links long")
    found = written(found, "join-found")
    clusters = written(connected(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "join-clusters")
    named = clusters.join(classes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("cluster_id"), F.count(F.lit(1)).alias("texts"))
    named = attach_groups(clusters, written(named, "join-named"), "root", "texts", n_classes).select("node", "cluster_id")
    near = named.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node")
    full = classes.join(near, "node", "left").select(
        "node", "copies", F.coalesce("cluster_id", "first_id").alias("cluster_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = attach_groups(rows, written(full, "join-full"), "node", "copies", n_rows)
    return out.select("doc_id", "cluster_id", "n_links", "copies", F.col("node").alias("text_hash"))


def drop_near(docs: DataFrame, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group of linked ones, that with the least id; columns unchanged. Rows without an
    id can't be told apart: they go if their group has an id, and all stay if it has none."""
    found = ngram_join(docs, words, threshold, id_col=id_col, text_col=text_col)
    return without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("cluster_id"))), id_col, text_col)
