import math
import random

import numpy as np
import pytest

from vigil.llm import nearest as nn
from vigil.llm.nearest import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    """All neighbours of each query row, in order."""
    ok = lambda v: v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = sorted({(i, tuple(np.float32(v).tolist())) for i, v, *_ in rows if i is not None and ok(v)})
    out = {}
    for i, v in rows:
        if asked(i):
            got = [(-float((np.array(v) * np.array(w)).sum()), j) for j, w in rows if (j, w) != (i, v) and len(w) == len(v)]
            out.setdefault(i, []).append([(j, -s) for s, j in sorted(got)[:k]])
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in out.items()}


def unit(rng, dim):
    v = rng.normal(size=dim)
    return (v / np.linalg.norm(v)).astype(np.float32).tolist()


def check(spark, rows, k=20, every=5, least=0.9):
    base = spark.createDataFrame(rows, SCHEMA)
    want, got = brute(rows, lambda i: i % every == 0, k), found(nearest(base, base.where(f"vec_id % {every} = 0"), k))
    hits = total = 0
    for q, lists in want.items():
        (rows_of_q,) = lists
        mine = got.get(q, [])
        assert len(mine) == len(rows_of_q), q
        assert mine == sorted(mine, key=lambda a: (-a[1], a[0])) and len({i for i, _ in mine}) == len(mine) and q not in {i for i, _ in mine}
        hits += len(set(mine) & set(rows_of_q))
        total += len(rows_of_q)
    assert set(got) == {q for q, (r,) in want.items() if r}
    assert not total or hits >= least * total, hits / total
    return hits / max(1, total)


@pytest.mark.parametrize("dim,n", [(64, 1500), (10, 1200), (1, 60), (3, 300)])
def test_recall(spark, dim, n):
    rng = np.random.default_rng(dim)
    check(spark, [(i, unit(rng, dim), 0) for i in range(n)])


def test_lengths_that_differ(spark):
    rng = np.random.default_rng(1)
    check(spark, [(i, (rng.lognormal(0, 1) * np.array(unit(rng, 16))).tolist(), 0) for i in range(900)])


def test_copies_and_ties(spark):
    """A third of the rows are one vector, axes tie exactly, and a tile holds fewer than there are."""
    rng = np.random.default_rng(2)
    one = unit(rng, 8)
    rows = [(i, one if i % 3 == 0 else [float(j == i % 8) for j in range(8)] if i % 3 == 1 else unit(rng, 8), 0) for i in range(600)]
    check(spark, rows, least=0.95)


def test_tiles(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = unit(rng, 32)
    rows = [(i, (np.array(base) + 0.05 * rng.normal(size=32)).tolist(), 0) for i in range(700)]
    whole = check(spark, rows)
    monkeypatch.setattr(nn, "TILE", 50)
    monkeypatch.setattr(nn, "BLOCK", 20)
    assert check(spark, rows) == whole


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 2), (1, None, None), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (10, [None, 1.0], 0), (None, [1.0, 1.0], 0),
        (20, [0.5, 0.5], None), (21, [2.0, 0.1], 0), (22, [2.0, 0.1], 0), (23, [-1.0, 0.0], 0), (25, [1.0, 2.0, 3.0], 0), (26, [1.0, 2.0, 3.0], 0), (30, [1.0], 0), (40, [-0.0, 1.0], 0), (41, [0.0, 1.0], 0),
    ]
    base = spark.createDataFrame(rows, SCHEMA)
    got = found(nearest(base, base.where("vec_id % 5 = 0"), 20))
    assert got == {q: r for q, (r,) in brute(rows, lambda i: i % 5 == 0, 20).items() if r} and 30 not in got and [i for i, _ in got[0]][:3] == [21, 22, 20]
    clash = base.selectExpr("*", "vec_id AS num", "vec_id AS key", "vec_id AS qid", "label AS dim", "label AS n", "'x' AS ids", "1 AS rank", "embedding AS vec", "'y' AS id")
    assert found(nearest(clash, clash.where("vec_id % 5 = 0"), 20)) == got
    nothing = spark.createDataFrame([], SCHEMA)
    assert nearest(nothing, nothing, 20).count() == 0 and nearest(base, nothing, 20).count() == 0


def test_several_vectors_of_an_id(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [0.9, 0.1], 0), (1, [0.8, 0.0], 0), (2, [0.1, 1.0], 0)]
    base = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.rank, r.vec_id) for r in nearest(base, base.where("vec_id = 0"), 3).collect())
    assert got == [(1, 0), (1, 0), (2, 1), (2, 1), (3, 2), (3, 2)]


def test_queries_that_find_too_few_meet_all(spark, monkeypatch):
    monkeypatch.setattr(nn, "_plan", lambda *a: {4: (2, 1, 1)})
    rng = np.random.default_rng(5)
    assert check(spark, [(i, unit(rng, 4), 0) for i in range(60)], k=20, least=0.5) >= 0.5


def test_several_hashes_a_bucket():
    """Probing finds what it should where buckets have two hashes, and the plan takes them for large tables of near neighbours."""
    rng = np.random.default_rng(6)
    asking = rng.normal(size=(20, 16))
    near = [(j, asking[j] + 0.1 * rng.normal(size=16)) for j in range(20) for _ in range(10)]
    tables, hashes, n = nn.cheapest(asking, near, 100_000_000, 5_000_000, 0.97)
    assert hashes >= 2
    hit = sum(any(nn.buckets(v[None], t, hashes)[0] in nn.probes(asking[j][None], t, hashes, n)[0] for t in range(tables)) for j, v in near)
    assert hit >= 0.97 * len(near)
    every = nn.probes(asking[:1], 0, 2, 1024)[0]
    assert len(set(every.tolist())) == 1024 and nn.buckets(asking[:1], 0, 2)[0] == every[0]


def test_rotation_keeps_lengths():
    rng = random.Random(7)
    for dim in (1, 2, 3, 7, 64, 100):
        x = np.array([[rng.gauss(0, 1e200) for _ in range(dim)] for _ in range(5)])
        assert np.allclose((nn.rotated(x, 1) ** 2).sum(axis=1), 1)
