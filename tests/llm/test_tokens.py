import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import SCHEMA, rows_of, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm import lm_scoring
from vigil.llm.encoding import encoder
from vigil.llm.packing import cut, pack, pack_in_order, plan
from vigil.llm.token_counts import token_counts


def test_encoder_equals_library(tokenizer):
    whole, fast, rng = Tokenizer.from_file(tokenizer), encoder(tokenizer), random.Random(2)
    alphabet = "ab'stREll  \n\t\r\x0b.,<|>endoftext1२é 漢　​\U0001f600"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [t[:5] + "<|endoftext|>" + t[5:] for t in texts[:500]]
    texts += [f"a{chr(c)}1 {chr(c)}{chr(c)} b{chr(c)}!" for c in range(0x3000)]
    for t, e in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert fast(t).tolist() == e.ids, repr(t)


def test_encoder_equals_library_over_all_code_points(tokenizer):
    whole, fast = Tokenizer.from_file(tokenizer), encoder(tokenizer)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4096):
        t = "".join(f"a{chr(c)} {chr(c)}1" for c in points[i : i + 4096])
        assert fast(t).tolist() == whole.encode(t, add_special_tokens=False).ids, points[i]


def test_very_long_texts(spark, tokenizer, tmp_path):
    """Runs of two million characters are counted and packed whole."""
    whole, n = Tokenizer.from_file(tokenizer), 2_000_000
    texts = [" " * n, "\n" * n, "a" * n, "x" + " \n" * (n // 2) + "y<|endoftext|> z"]
    want = [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = {r.doc_id: r for r in token_counts(docs, tokenizer, str(tmp_path / "long")).collect()}
    assert [(got[i].n_tokens, got[i].n_bytes) for i in range(4)] == [(k, len(t)) for k, t in zip(want, texts)]
    sizes = {r.doc_id: r.n for r in pack(docs, tokenizer).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert [sizes[i] for i in range(4)] == [k + 1 for k in want]


def test_counts(spark, edges, edge_rows, nothing, clashing, tokenizer, tmp_path):
    whole = Tokenizer.from_file(tokenizer)
    want = sorted([(r[0], len((r[1] or "").encode()), len(whole.encode(r[1] or "", add_special_tokens=False).ids)) for r in edge_rows], key=str)
    cache = str(tmp_path / "cache")
    for df in (edges, clashing, edges):
        got = token_counts(df, tokenizer, cache).collect()
        assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=str) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_counts(nothing, tokenizer, cache).count() == 0
    # Only distinct misses were encoded, once.
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r[1] or "" for r in edge_rows})
    more = spark.createDataFrame([(50, "a new text", "en", "a", 9), (51, "", "en", "a", 0)], SCHEMA)
    token_counts(more, tokenizer, cache).count()
    assert spark.read.parquet(cache).count() == stored.count() + 1


def check_packing(rows, got, tokenizer, capacity):
    whole = Tokenizer.from_file(tokenizer)
    want = sorted((r[0], k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for r in rows for ids in [whole.encode(r[1] or "", add_special_tokens=False).ids + [2]] for k, (s, n) in enumerate(cut(len(ids), capacity)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r.length for r in got) // capacity)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing(spark, tokenizer, capacity):
    rng = random.Random(4)
    rows = rows_of([None, "", *[sentence(rng, rng.choice([1, 3, 30, 400])) for _ in range(150)], *["the same"] * 40])
    n, least = check_packing(rows, pack(spark.createDataFrame(rows, SCHEMA), tokenizer, capacity).collect(), tokenizer, capacity)
    assert n <= least * 1.05 + 2


def test_packing_edges(spark, edges, edge_rows, nothing, clashing, tokenizer):
    got = pack(clashing, tokenizer, 64).collect()
    assert {str(r.doc_id) for r in got} == {str(r[0]) for r in edge_rows}
    assert pack(nothing, tokenizer).count() == 0


def test_packing_in_order_edges(spark, edges, edge_rows, nothing, clashing, tokenizer, tmp_path):
    """The pipeline's last stage: nulls, empty and repeated rows, clashing columns, an empty table; from files and not."""
    for name, df in (("edges", edges), ("clashing", clashing)):
        df.write.parquet(str(tmp_path / name))
        for docs in (df, spark.read.parquet(str(tmp_path / name))):
            got = pack_in_order(docs, tokenizer, 64).collect()
            assert {str(r.doc_id) for r in got} == {str(r[0]) for r in edge_rows}
            assert sorted({r.sequence_id for r in got}) == list(range(1 + max(r.sequence_id for r in got)))
    nothing.write.parquet(str(tmp_path / "nothing"))
    assert pack_in_order(nothing, tokenizer).count() == pack_in_order(spark.read.parquet(str(tmp_path / "nothing")), tokenizer).count() == 0


def test_packing_in_order_over_many_stretches(spark, tokenizer, tmp_path, monkeypatch):
    """Sequences are numbered in the order of the rows, over files, parts of files and parts of stretches."""
    monkeypatch.setattr("vigil.llm.packing.STRETCH", 4)
    monkeypatch.setattr("vigil.llm.packing.STRETCHES", 3)
    rng = random.Random(8)
    rows = rows_of([sentence(rng, rng.randint(1, 30)) for _ in range(300)])
    spark.createDataFrame(rows, SCHEMA).repartitionByRange(13, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "many"))
    got = pack_in_order(spark.read.parquet(str(tmp_path / "many")), tokenizer, 64).collect()
    check_packing(rows, got, tokenizer, 64)
    numbers = sorted({r.sequence_id for r in got})
    assert numbers == list(range(len(numbers)))
    # Files hold ascending ids, so a later sequence never holds only rows of an earlier stretch than another's.
    least = defaultdict(lambda: 10**9)
    for r in got:
        least[r.sequence_id] = min(least[r.sequence_id], r.doc_id)
    assert all(least[n + 1] >= least[n] - 4 for n in numbers[:-1])


def test_totals_before(spark):
    from vigil.llm.common import totals_before

    rng = random.Random(9)
    rows = [(b, i, rng.randint(0, 9)) for b in (0, 2, 3, 7) for i in range(rng.randint(1, 20))]
    got = {(r.b, r.i): r.before for r in totals_before(spark.createDataFrame(rows, "b int, i int, v long"), "b", ["i"], "v", "before").collect()}
    assert got == {(b, i): sum(v for c, j, v in rows if (c, j) < (b, i)) for b, i, _ in rows}


def test_plan_is_best_fit():
    rng = random.Random(6)
    for _ in range(50):
        sizes = [min(64, max(1, int(rng.lognormvariate(2.5, 1)))) for _ in range(rng.randint(1, 300))]
        free = []
        for s in sorted(sizes, reverse=True):  # plain best fit, one piece at a time
            fit = min((f for f in free if f >= s), default=None)
            if fit is None:
                free.append(64 - s)
            else:
                free[free.index(fit)] -= s
        runs = plan({s: sizes.count(s) for s in sizes}, 64)
        used = {first + i // each for _, a, b, first, each, _ in runs for i in range(b - a)}
        assert len(used) == len(free)


def test_lm(spark, edges, edge_rows, nothing, clashing):
    how = {"frequent": 20, "buckets": 8, "width": 8, "rounds": 2}
    got = lm_scoring.score(edges, **how).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        assert (r.n_tokens == 0) == (r.mean_log_prob is None) and r.log_prob <= 0
    assert lm_scoring.score(nothing, **how).count() == 0 and lm_scoring.score(clashing, **how).count() == len(edge_rows)
    # A language of fixed word order: shuffled texts score worse.
    rng = random.Random(1)
    ordered = [" ".join("one two three four five six seven".split() * 12) for _ in range(60)]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in ordered[:10]]
    rows = {r.doc_id: r.mean_log_prob for r in lm_scoring.score(spark.createDataFrame(rows_of(ordered + mixed), SCHEMA), frequent=20, buckets=4, width=8, rounds=3, rate=0.3).collect()}
    assert min(rows[i] for i in range(60)) > max(rows[i] for i in range(60, 70))


def vocabulary_of(texts, frequent, buckets):
    hashed = [lm_scoring.word_hashes(d, o)[0] for _, d, o in lm_scoring.chunks(lm_scoring.pa.array([" ".join(texts)], lm_scoring.pa.large_string()))][0]
    words, n = np.unique(hashed, return_counts=True)
    return lm_scoring.Vocabulary([int(w) for w in words[np.argsort(-n)][:frequent]], buckets), hashed


def test_lm_log_probs_are_normalised():
    """Over the real outputs, whatever their number: places of a class that stand for no word get nothing."""
    for frequent, buckets in ((60, 9), (0, 1), (63, 1), (64, 1), (100, 32), (896, 128), (127, 3)):
        vocabulary = lm_scoring.Vocabulary(list(range(1, frequent + 1)), buckets)
        real = np.sort(np.array([*vocabulary.words, *vocabulary.shared]))
        assert len(set(real.tolist())) == frequent + buckets <= vocabulary.size == vocabulary.padding.size and not vocabulary.padding.ravel()[real].any()
        net = lm_scoring.new_net(vocabulary, 4, 2, 3)
        context = np.array([[0, 1 % vocabulary.size, vocabulary.size, 0]] * vocabulary.size)
        logs = lm_scoring.log_probs(net, context, np.arange(vocabulary.size))
        assert abs(np.exp(logs[real]).sum() - 1) < 1e-5 and not np.exp(logs[vocabulary.padding.ravel()]).any()
        # Training leaves them so.
        squares = {k: np.full_like(v, 1.0) for k, v in net.items()}
        lm_scoring.train(net, squares, context[: len(real)], real, rate=0.5)
        assert abs(np.exp(lm_scoring.log_probs(net, context[: len(real)], real)).sum() - 1) < 1e-5
    ids, counts = np.array([1, 2, 3, 4]), np.array([3, 1])
    assert lm_scoring.contexts(ids, counts, 2, 9).tolist() == [[9, 9, 2, 3], [1, 9, 3, 9], [2, 1, 9, 9], [9, 9, 9, 9]]


def test_lm_step_follows_the_gradient():
    """A step of training moves every weight by the numeric gradient of the mean loss, scaled as Adagrad does."""
    rng = np.random.default_rng(5)
    vocabulary = lm_scoring.Vocabulary(list(range(1, 61)), 9)
    net = {k: rng.normal(0, 0.3, v.shape).astype(np.float64) for k, v in lm_scoring.new_net(vocabulary, 4, 2, 3).items()}
    context, target = rng.integers(0, vocabulary.size + 1, (40, 4)), rng.integers(0, vocabulary.size, 40)
    loss = lambda n: -lm_scoring.log_probs(n, context, target).mean()
    after, squares = {k: v.copy() for k, v in net.items()}, {k: np.full_like(v, 1.0) for k, v in net.items()}
    lm_scoring.train(after, squares, context, target, rate=1.0)
    for name, values in net.items():
        for _ in range(12):
            at = tuple(rng.integers(0, d) for d in values.shape)
            up, down = ({**net, name: values.copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            assert abs(values[at] - after[name][at] - slope / np.sqrt(1 + slope * slope)) < 1e-5, name


def test_lm_scores_each_words_own_probability(spark):
    """The scores by brute force: every word's output from the fitted network, times the word's share of its bucket."""
    texts = ["aa " * 30 + "bb " * 20 + "cc cc cc dd", "dd ee ff gg hh", "aa bb cc", "aa bb hh"]
    df = spark.createDataFrame(rows_of(texts), SCHEMA)
    how = {"frequent": 2, "buckets": 3, "width": 4}
    got = {r.doc_id: (r.log_prob, r.n_tokens) for r in lm_scoring.score(df, **how).collect()}
    net, vocabulary, _ = lm_scoring.fit(df.select("doc_id", "text"), **how)
    _, every = vocabulary_of(texts, 2, 3)
    n, of = {int(w): int((every == w).sum()) for w in every}, {int(o): int((vocabulary.ids(every) == o).sum()) for o in range(vocabulary.size)}
    for i, t in enumerate(texts):
        _, words = vocabulary_of([t], 2, 3)
        ids, own = vocabulary.ids(words).tolist(), 0.0
        for at, (w, o) in enumerate(zip(words.tolist(), ids)):
            around = [ids[p] if 0 <= p < len(ids) else vocabulary.size for p in (at - 1, at - 2, at + 1, at + 2)]
            h = np.tanh(sum(net["embed"][k][x].astype(float) for k, x in enumerate(around)) + net["hidden"])
            a, b = h @ net["class"] + net["class_bias"], h @ net["out"][o // vocabulary.per] + net["bias"][o // vocabulary.per]
            own += a[o // vocabulary.per] - np.log(np.exp(a).sum()) + b[o % vocabulary.per] - np.log(np.exp(b).sum())
            own += np.log(n[w] / of[o]) if vocabulary.find(words)[1][at] else 0
        assert got[i][1] == len(ids) and abs(got[i][0] - own) < 1e-3


def test_lm_trains_on_every_position_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 9, n) for n in (3, 0, 70_000, 1, 200_000, 5)]
    parts = list(lm_scoring.slices(iter(texts), 2, 9))
    want = lm_scoring.contexts(np.concatenate(texts), np.array(list(map(len, texts))), 2, 9)
    assert (np.concatenate([c for c, _ in parts]) == want).all() and (np.concatenate([t for _, t in parts]) == np.concatenate(texts)).all()
    assert max(len(t) for _, t in parts) <= 2 * lm_scoring.SLICE


def test_lm_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD", 3_000)
    rng = random.Random(3)
    rows = rows_of([sentence(rng, rng.randint(0, 120)) for _ in range(300)] + ["the same text"] * 30)
    how = {"frequent": 50, "buckets": 8, "width": 8}
    one = {r.doc_id: r.log_prob for r in lm_scoring.score(spark.createDataFrame(rows, SCHEMA).coalesce(1), **how).collect()}
    rng.shuffle(rows)
    many = {r.doc_id: r.log_prob for r in lm_scoring.score(spark.createDataFrame(rows, SCHEMA).repartition(7), **how).collect()}
    assert one.keys() == many.keys() and max(abs(one[i] - many[i]) for i in one) < 1e-3
    assert max(many[i] for i in range(300, 330)) - min(many[i] for i in range(300, 330)) < 1e-6  # repeated texts score alike
