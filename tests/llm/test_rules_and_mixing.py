import math
import random
import re
from collections import Counter
from fractions import Fraction
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, rows_of, sentence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import toxicity as toxicity_module
from vigil.llm.mixing import mix, mixed_order, period, phases, whole_weights
from vigil.llm.quality_rules import binomial_below, drop_rejected, judge, measures
from vigil.llm.sharding import ManifestConflict, ShardStore, ingest, placed
from vigil.llm.toxicity import toxicity


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures(spark, edge_rows):
    rng = random.Random(3)
    loop = sentence(rng, 9)
    texts = [r[1] for r in edge_rows] + ["a b c d e f g h", "a " * 9, "x y z " * 30, f"{loop} {sentence(rng, 20)} {loop}", "l\nl\n\nl \n \nk", "\x0b\x0ca\x0db", "#$ |<é> x", "漢 " * 20]
    got = measures(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(texts[r.doc_id]), texts[r.doc_id]


def test_binomial(spark):
    rows = [(k, n) for n in (1, 10, 300, 5000) for k in (0, 1, 2, n // 100, n // 60)]
    got = spark.createDataFrame(rows, "k long, n long").select("k", "n", binomial_below(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for r in got:
        want = sum(comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1)) if r.k < 0.02 * r.n else 1.0
        assert abs(r.p - want) < 1e-9


def test_judge_holds_the_risk(spark, edges, edge_rows, nothing, clashing, labels):
    rng = random.Random(9)
    good = [sentence(rng, 60) for _ in range(900)]
    bad = [" ".join(w + "###" for w in sentence(rng, 60).split()) for _ in range(100)]
    docs = spark.createDataFrame(rows_of(good + bad), SCHEMA)
    truth = spark.createDataFrame([(i, int(i < 900)) for i in range(1000)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in judge(docs, truth).collect()}
    assert not any(got[i] for i in range(900, 1000)) and sum(not got[i] for i in range(900)) <= 45
    few = {r.doc_id: r.kept for r in judge(docs, truth.where("doc_id < 50 OR doc_id > 990")).collect()}
    assert all(few[i] for i in range(1000))  # too few labels to show that a cutoff is safe
    assert judge(nothing, labels).count() == 0 and judge(edges, labels.limit(0)).count() == len(edge_rows)
    assert judge(clashing, labels).count() == len(edge_rows)
    kept = drop_rejected(clashing, labels)
    assert kept.columns == clashing.columns and {r[0] for r in kept.select("doc_id").collect()} == {4, 5}


def test_toxicity(spark, edges, edge_rows, nothing, clashing, labels):
    rng = random.Random(2)
    texts, toxic = [], []
    for i in range(900):
        lines = [sentence(rng, 8) for _ in range(6)]
        if i % 5 == 0:
            lines[i % 6] = f"{sentence(rng, 3)} {rng.choice(['vile', 'scumling'])}{rng.choice(['', 'er'])}!! {sentence(rng, 3)}"
        texts.append(". ".join(lines) + ".")
        toxic.append(int(i % 5 == 0))
    docs, truth = spark.createDataFrame(rows_of(texts), SCHEMA), spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    got = toxicity(docs, truth).collect()
    held = [r for r in got if r.held_out]
    assert 200 < len(held) < 400 and sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    for r in held:
        if toxic[r.doc_id] and r.predicted:
            assert re.search("vile|scumling", texts[r.doc_id][r.worst_start : r.worst_end])
    # Held-out labels are never read.
    lied = truth.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert [r.score for r in toxicity(docs, lied).orderBy("doc_id").collect()] == [r.score for r in toxicity(docs, truth).orderBy("doc_id").collect()]
    assert toxicity(edges, labels).count() == toxicity(clashing, labels).count() == len(edge_rows)
    assert toxicity(nothing, labels).count() == 0 and toxicity(edges, labels.limit(0)).where("score <> 0").count() == 0


def plain_noisy_or(docs, weights, bias):
    """Each document's probability from (sentences, known features of some of them), one sentence at a time."""
    out = []
    for n, bags in docs:
        clean = 1.0
        for k in range(n):
            clean *= 1 - 1 / (1 + math.exp(-(bias + sum(weights[f] for f in bags[k]) if k < len(bags) else bias)))
        out.append(1 - clean)
    return out


def test_noisy_or_scores_equal_a_plain_loop():
    rng = random.Random(11)
    words = {"vile$": 0, "vil": 1, "scum$": 2, "nice$": 3}
    weights, bias = np.array([3.0, 1.5, 4.0, -2.0]), -5.0
    texts = ["", "...", *[". ".join(" ".join(rng.choice(["vile", "vilest", "scum", "nice", "word"]) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 9))) for _ in range(200)]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([False] * len(texts)), pa.array(texts)], ["doc_id", "held_out", "text"])
    (got,) = toxicity_module._score(words, weights, bias, None, 0.5)(iter([batch]))
    docs = []
    for t in texts:
        bags = [{f for w in re.findall(r"[^\W\d_]+", s.lower()) for f in ("vile$", "vil", "scum$", "nice$") if f == f"{w}$" or (f == "vil" and w.startswith("vil") and len(w) > 3)} for s in re.split(r"[.!?\n]+", t) if re.search(r"[^\W\d_]", s)]
        docs.append((len(bags), [[words[f] for f in b] for b in bags]))
    assert np.allclose(got["score"], plain_noisy_or(docs, weights, bias), atol=1e-12)


def test_noisy_or_fit_is_where_the_gradient_vanishes():
    """The fit's loss, by a plain loop, has a numeric gradient near zero, and moving away from the fit makes it larger."""
    rng = random.Random(12)
    docs = [(rng.randint(1, 6), []) for _ in range(120)]
    docs = [(n, [[f for f in range(5) if rng.random() < 0.3] for _ in range(rng.randint(0, n))]) for n, _ in docs]
    truth = [int(rng.random() < p) for p in plain_noisy_or(docs, [2.0, -1.0, 1.0, 0.0, 3.0], -2.0)]
    decay = 1e-3
    weights, bias = toxicity_module.fit_noisy_or(np.array(truth), np.array([n for n, _ in docs]), [b for _, b in docs], 5, steps=4000, rate=0.02, decay=decay)

    def loss(values):
        p = plain_noisy_or(docs, values[:5], values[5])
        return -sum(math.log(x if y else 1 - x) for x, y in zip(p, truth)) / len(docs) + decay / 2 * sum(v * v for v in values[:5])

    at = [*weights, bias]
    for k in range(6):
        up, down = ([v + d * (i == k) for i, v in enumerate(at)] for d in (1e-4, -1e-4))
        assert abs(loss(up) - loss(down)) / 2e-4 < 2e-3
        assert all(loss([v + d * (i == k) for i, v in enumerate(at)]) > loss(at) for d in (0.5, -0.5))


def test_period_and_phases():
    rng = random.Random(3)
    for _ in range(100):
        w = {f"s{i}": rng.randint(1, 9) for i in range(rng.randint(1, 8))}
        q, done = sum(w.values()), Counter()
        for slot, s in period(w):
            done[s] += 1
            assert all(abs(done[x] - Fraction((slot + 1) * w[x], q)) < 1 for x in w)
        b = {s: rng.randint(0, 100) for s in w}
        place = {(p.source, j): p.start + (j - p.first) // p.weight * p.period + p.at[(j - p.first) % p.weight] for p in phases(b, w) for j in range(p.first, p.end)}
        assert sorted(place.values()) == list(range(sum(b.values()))) and set(place) == {(s, j) for s in b for j in range(b[s])}
        # By brute force: a slot at a time, and anew when a source has run out.
        at, start, ran = 0, 0, Counter()
        while any(b[s] > ran[s] for s in b):
            own = {s: w[s] for s in sorted(b) if b[s] > ran[s]}
            total, phase = sum(own.values()), Counter()
            while all(b[s] > ran[s] for s in own):
                ready = [(-(-(phase[s] + 1) * total // n), (phase[s] + 1) * total // n, s) for s, n in own.items() if phase[s] * total // n <= at - start]
                s = min(ready)[2]
                assert place[s, ran[s]] == at
                ran[s], phase[s], at = ran[s] + 1, phase[s] + 1, at + 1
                assert all(abs(phase[x] - Fraction((at - start) * own[x], total)) < 1 for x in own)
            start = at


def test_weights_are_exact(monkeypatch):
    assert whole_weights({"a": 0.5, "b": 0.25, "c": 0.25}) == {"a": 2, "b": 1, "c": 1}
    assert whole_weights({"a": 0.9996, "b": 0.0004}) == {"a": 2499, "b": 1}
    assert whole_weights({"a": 1, "b": Fraction(1, 3)}) == {"a": 3, "b": 1}
    for bad in (0, -1, float("nan")):
        with pytest.raises(ValueError):
            whole_weights({"a": bad})
    # Many sources: the plan has no more slots than there are blocks.
    sizes = {f"s{i}": 1 + i % 7 for i in range(1_500)}
    parts = phases(sizes, dict.fromkeys(sizes, 1))
    assert sum(p.end - p.first for p in parts) == sum(sizes.values()) and sum(len(p.at) for p in parts) <= sum(sizes.values())
    monkeypatch.setattr("vigil.llm.mixing.MAX_PLAN", 1000)
    with pytest.raises(ValueError):
        phases({"a": 5000, "b": 5000}, {"a": 9999, "b": 10_000})


def test_mix(spark, edges, edge_rows, nothing, clashing, tmp_path):
    rows = rows_of(["t"] * 300, "hot") + [(1000 + i, "t", "en", f"s{i % 3}", 1) for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix(docs, {"hot": 2.0}, block_rows=5).collect()
    assert len(got) == 390 and len({r.position for r in got}) == 390 and len({(r.doc_id) for r in got}) == 390
    start, n = 0, {"hot": 60, "s0": 6, "s1": 6, "s2": 6}
    slots = {r.slot: r.source for r in got}
    done = Counter()
    for slot in range(6 * 5):
        if any(done[s] == n[s] for s in n):  # the first source has run out: the others go on among themselves
            break
        done[slots[slot]] += 1
        assert abs(done["hot"] - (slot + 1) * 2 / 5) < 1 and all(abs(done[s] - (slot + 1) / 5) < 1 for s in ("s0", "s1", "s2"))
    assert sorted(slots) == list(range(start, sum(n.values())))
    assert mix(edges).count() == len(edge_rows) == mix(clashing).count() and mix(nothing).count() == 0
    laid = mixed_order(clashing, block_rows=1)
    assert laid.columns == clashing.columns and laid.exceptAll(clashing).count() == 0 == clashing.exceptAll(laid).count()
    mixed_order(docs, {"hot": 2.0}, block_rows=5).coalesce(1).write.parquet(str(tmp_path / "m"))
    order = [r.source for r in spark.read.parquet(str(tmp_path / "m")).collect()]
    assert order == [slots[k] for k in sorted(slots) for _ in range(5)]


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_shards(spark, edges, edge_rows, nothing, clashing, tmp_path):
    store = ShardStore(spark, str(tmp_path / "store"), target_bytes=20_000, tier_base=1_000)
    with pytest.raises(ValueError):
        store.read()
    first = store.append(edges)
    more = [spark.createDataFrame(rows_of([sentence(random.Random(k), 300)] * 20), SCHEMA) for k in range(10)]
    ingest(store, [edges, nothing, *more], alone=True)
    every = reduce(DataFrame.unionByName, [edges, edges, *more])
    assert same_rows(store.read(), every)
    assert max(Counter(map(store.tier, store.runs())).values()) < store.fan
    old = store.versions()[-1]
    store.append(edges)
    assert store.read(old).count() + len(edge_rows) == store.read().count()  # a version is immutable
    with pytest.raises(ManifestConflict):
        store._commit(old, [])
    where = placed(store)
    assert where.where("run IS NULL OR shard IS NULL OR shard_bytes IS NULL").count() == 0 and first == 1
    assert same_rows(where.select("row.*"), every.unionByName(edges))
    spark.range(3).write.parquet(str(tmp_path / "store/data/run-lost"))
    assert store.vacuum(keep=1, grace_s=0) >= 1 and store.vacuum() == 0 and same_rows(store.read(), every.unionByName(edges))
    other = ShardStore(spark, str(tmp_path / "other"))
    odd = clashing.withColumns({c: F.lit(1) for c in ("run", "shard", "shard_bytes", "arrival", "__run", "__bytes")})
    ingest(other, other.append_split(odd, 6, by=["doc_id", "text"]))
    assert same_rows(placed(other).select("row.*"), odd) and other.latest() > 2
    third = ShardStore(spark, str(tmp_path / "third"))
    ingest(third, third.append_split(nothing, 6, by=["doc_id"]))
    assert third.latest() == 1 and same_rows(third.read(), nothing)


@pytest.mark.parametrize("task", ["append", "compact"])
def test_writers_that_interleave_lose_nothing(spark, tmp_path, monkeypatch, task):
    """While one writer writes its run, another appends, and in turn merges all there is."""
    a, b = (ShardStore(spark, str(tmp_path / "store")) for _ in range(2))
    part = lambda k: spark.range(10 * k, 10 * k + 10)
    for k in range(3 if task == "append" else 4):
        a.append(part(k))
    write = ShardStore._write

    def slow(self, df, version, codec):
        run = write(self, df, version, codec)
        if self is a:
            b.append(part(4))
            b.compact()
        return run

    monkeypatch.setattr(ShardStore, "_write", slow)
    a.append(part(3)) if task == "append" else a.compact()
    assert sorted(r.id for r in a.read().collect()) == list(range(50))
    a.vacuum(keep=1, grace_s=0)
    assert sorted(r.id for r in b.read().collect()) == list(range(50))


def test_sharding_query_merges(spark, tmp_path):
    """One input file is enough for many arrivals."""
    from vigil.llm import queries

    docs = spark.createDataFrame(rows_of([sentence(random.Random(k), 30) for k in range(200)]), SCHEMA)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op6_sharding(spark, str(tmp_path))
    runs = {f.split("/")[-2] for f in got.inputFiles()}
    assert len(runs) < 4 and got.count() == 200
