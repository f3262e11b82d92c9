import random
from collections import defaultdict

from helpers import SCHEMA, edited, rows_of, sentence
from pyspark.sql import functions as F

from vigil.llm.exact_dedup import drop_exact, exact_groups
from vigil.llm.ngram_join import drop_near, least_agreeing, ngram_join, similar_pairs
from vigil.llm.substring_dedup import chains, repeated_passages


def brute_exact(rows, keep):
    by = defaultdict(list)
    for r in rows:
        by[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = [i for i in by[r[1] or ""] if i is not None]
        best = keep(ids) if ids else None
        out.append((r[0], best, len(by[r[1] or ""]), r[0] == best))
    return sorted(out, key=str)


def test_exact_edges(spark, edges, edge_rows, nothing, clashing):
    for name, keep in (("max", max), ("min", min)):
        got = [tuple(r) for r in exact_groups(edges, keep=name).select("doc_id", "keep_id", "group_size", "kept").collect()]
        assert sorted(got, key=str) == brute_exact(edge_rows, keep)
    assert exact_groups(nothing).count() == 0
    assert exact_groups(clashing).count() == len(edge_rows)
    kept = drop_exact(clashing, keep="max")
    assert kept.columns == clashing.columns and drop_exact(nothing).count() == 0
    assert {r[0] for r in kept.select("text").collect() if r[0]} == {r[1] for r in edge_rows if r[1]}


def test_exact_survives_collisions(spark, edges, edge_rows):
    got = exact_groups(edges, keep="max", hash_of=lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 2), 32, "0"))).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_exact(edge_rows, max)


def shingle_set(text):
    import re

    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near(rows, t=0.8):
    links, root = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingle_set(r[1]) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            both = len(sets[i] & sets[j])
            if same or (both and both * 10 >= 8 * (len(sets[i]) + len(sets[j]) - both)):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted([(r[0], least.get(find(i)), links[i]) for i, r in enumerate(rows)], key=str)


def near_rows():
    rng = random.Random(3)
    texts = []
    for _ in range(25):
        base = sentence(rng, rng.randint(5, 200))
        texts += [base] + [edited(rng, base, rng.choice([0.0, 0.005, 0.02, 0.05])) for _ in range(rng.randint(0, 4))]
    base = sentence(rng, 120)
    texts += [edited(rng, base, 0.01) for _ in range(40)]
    return rows_of(texts)


def test_near_against_brute_force(spark):
    rows = near_rows()
    got = ngram_join(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "cluster_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_near(rows)


def test_near_in_many_blocks(spark, monkeypatch):
    """A component over several blocks gives the same links."""
    import vigil.llm.ngram_join as join

    monkeypatch.setattr(join, "BLOCK_TEXTS", 7)
    rows = near_rows()
    got = ngram_join(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "cluster_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_near(rows)


def test_near_edges(spark, edges, edge_rows, nothing, clashing):
    got = ngram_join(edges).select("doc_id", "cluster_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_near(edge_rows)
    assert ngram_join(nothing).count() == 0
    assert drop_near(clashing).columns == clashing.columns


def test_pruning_bound():
    assert least_agreeing(0.8, 1e-4, 16) < 16 * 0.8
    assert least_agreeing(0.8, 1e-4, 128) < 128 * 0.8
    assert [least_agreeing(0.8, 1e-4, n) for n in (16, 32, 64, 128)] == sorted(least_agreeing(0.8, 1e-4, n) for n in (16, 32, 64, 128))


def test_similar_pairs_between_sides():
    import numpy as np

    sets = [np.arange(10, dtype=np.uint64), np.arange(1, 11, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)]
    a, b = similar_pairs(sets, None, 0.8, 1e-4)
    assert list(zip(a.tolist(), b.tolist())) == [(0, 1)]
    a, b = similar_pairs(sets, np.array([0, 0, 1]), 0.8, 1e-4)
    assert not len(a)


def brute_chain(a, b, k, cost):
    n, best = len(a), []
    for i in range(n):
        before = [best[j] - cost * (a[i] - a[j] + b[i] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]
        best.append(k + max([0.0, *before]))
    return max(best, default=0)


def test_chain_scores_against_quadratic():
    rng = random.Random(1)
    for _ in range(200):
        m = sorted({(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(rng.randint(1, 25))})
        a, b = [x[0] for x in m], [x[1] for x in m]
        found = chains(a, b, 6, 0.1, least=1)
        score = lambda c: 6 * len(c) - sum(0.1 * (a[y] - a[x] + b[y] - b[x]) for x, y in zip(c, c[1:]))
        assert abs(max(score(c) for c in found) - brute_chain(a, b, 6, 0.1)) < 1e-9
        assert sorted(i for c in found for i in c) == list(range(len(a)))
        for c in found:
            assert all(a[x] < a[y] and b[x] < b[y] for x, y in zip(c, c[1:]))


def test_passages(spark):
    rng = random.Random(8)
    exact, fuzzy = sentence(rng, 60), sentence(rng, 90)
    texts = [sentence(rng, 150) for _ in range(40)]
    for i in (3, 11, 19, 30):
        texts[i] = f"{sentence(rng, 30)} {exact} {sentence(rng, 50)}"
    for i in (5, 21):
        texts[i] = f"{sentence(rng, 20)} {edited(rng, fuzzy, 0.06)} {sentence(rng, 40)}"
    texts[33] = texts[34] = sentence(rng, 70)
    texts[36] = f"{sentence(rng, 20)} {' '.join(exact.split()[:30])} {sentence(rng, 40)}"
    got = repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    linked = {frozenset((r.doc_id, r.other_doc_id)) for r in got}
    assert {i for p in linked for i in p} == {3, 11, 19, 30, 5, 21, 33, 34}
    group = {3}
    for _ in range(4):
        group |= {i for p in linked if p & group for i in p}
    assert group == {3, 11, 19, 30}
    for r in got:
        assert r.end - r.start >= 50 and r.matched >= 0.8 * (r.end - r.start)
        if r.kind == "passage" and {r.doc_id, r.other_doc_id} <= {3, 11, 19, 30}:
            words = texts[r.doc_id].split()[r.start : r.end]
            assert set(exact.split()) <= set(words)


def test_passage_edges(spark, edges, nothing, clashing):
    got = {(r.doc_id, r.other_doc_id) for r in repeated_passages(edges).collect()}
    assert got == {(5, 4)}
    assert repeated_passages(nothing).count() == 0
    assert repeated_passages(clashing).count() == 1


def test_hot_groups_give_the_same(spark, edges, edge_rows, monkeypatch):
    """With groups hot from three rows on: copies, stars and ranks come out alike."""
    import vigil.llm.common as common

    monkeypatch.setattr(common, "HOT_LEAST", 3)
    monkeypatch.setattr(common, "HOT_SHARE", 0.0)
    rows = near_rows()[-60:] + [(900 + i, "copy of a text", "en", "s", 1) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = exact_groups(df, keep="max").select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_exact(rows, max)
    got = ngram_join(df).select("doc_id", "cluster_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_near(rows)
    ranked = common.rank_within(common.written(df, "t"), ["lang"], ["doc_id"], rows_per_bucket=5).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(len(rows))) and all(r["rank_of"] == len(rows) for r in ranked)


def with_edits(rng, words, n):
    """words with n of them replaced, the first and last too."""
    out = list(words)
    for i in [0, len(out) - 1, *rng.sample(range(1, len(out) - 1), n - 2)]:
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def fresh_words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def test_passages_at_the_threshold(spark):
    """Of 40 pairs each with a passage of 50 to 60 words at identity 0.80 to 0.85, nearly all are found; pairs just below are not."""
    rng = random.Random(5)
    texts, below = [], []
    for i in range(40):
        passage = fresh_words(rng, 50 + i % 11)
        n = int(len(passage) * (0.2 if i % 2 else 0.15))
        for words in (passage, with_edits(rng, passage, n)):
            texts.append(" ".join([*fresh_words(rng, 30), *words, *fresh_words(rng, 30)]))
    for i in range(10):
        passage = fresh_words(rng, 50)
        below.append(len(texts))
        for words in (passage, with_edits(rng, passage, 13)):
            texts.append(" ".join([*fresh_words(rng, 30), *words, *fresh_words(rng, 30)]))
    got = repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    found = {min(r.doc_id, r.other_doc_id) for r in got}
    assert len(found & set(range(0, 80, 2))) >= 38 and not found & set(below)
    for r in got:
        assert abs(r.doc_id - r.other_doc_id) == 1
        x, y = texts[r.doc_id].split()[r.start : r.end], texts[r.other_doc_id].split()[r.other_start : r.other_end]
        assert len(x) >= 50 and r.matched >= 0.8 * len(x) and sum(u == v for u, v in zip(x, y)) >= 0.8 * len(x)


def test_passages_of_frequent_lines(spark):
    """Ten 60-word passages in two texts each; either half occurs in 20 other texts as well."""
    rng = random.Random(6)
    texts, whole = [], []
    for _ in range(10):
        halves = [fresh_words(rng, 30), fresh_words(rng, 30)]
        own = [" ".join([*fresh_words(rng, 30), *halves[0], *halves[1], *fresh_words(rng, 30)]) for _ in range(2)]
        texts += [" ".join([*fresh_words(rng, 40), *half, *fresh_words(rng, 40)]) for half in halves for _ in range(20)]
        texts += own
        whole.append(frozenset(own))
    rng.shuffle(texts)
    got = repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    assert {frozenset((texts[r.doc_id], texts[r.other_doc_id])) for r in got} == set(whole)


def test_passage_twice_in_a_text(spark):
    """Every place of a shared passage is returned, whichever of the texts holds it more than once."""
    rng = random.Random(7)
    texts, places = [], {}
    for _ in range(6):
        passage = fresh_words(rng, 60)
        once = [*fresh_words(rng, 30), *passage, *fresh_words(rng, 30)]
        thrice = [*fresh_words(rng, 20), *passage, *fresh_words(rng, 90), *passage, *fresh_words(rng, 80), *passage]
        places |= {len(texts): [30], len(texts) + 1: [20, 170, 310]}
        texts += [" ".join(once), " ".join(thrice)]
    got = repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    spans = defaultdict(list)
    for r in got:
        spans[r.doc_id].append((r.start, r.end))
        spans[r.other_doc_id].append((r.other_start, r.other_end))
    for i, starts in places.items():
        for s in starts:
            assert any(a <= s + 2 and b >= s + 58 for a, b in spans[i])


def test_filters_instead_of_broadcasts(spark, edges, edge_rows, clashing, tokenizer, tmp_path, monkeypatch):
    """With no broadcast of keys and with filters, all operators that leave rows out give the same rows."""
    import vigil.llm.common as common
    import vigil.llm.exact_dedup as exact
    from vigil.llm.token_counts import token_counts

    near = near_rows()[-60:] + [(900 + i, "copy of a text", "en", "s", 1) for i in range(6)] + [(950, None, "en", "s", 1), (951, "", None, None, None)]
    df = spark.createDataFrame(near, SCHEMA)
    plain = sorted([tuple(r) for r in token_counts(df, tokenizer, str(tmp_path / "a")).collect()])
    few = sorted([r.doc_id for r in drop_near(drop_exact(df, keep="max")).collect()])
    for keys in (1 << 24, -1):  # by filters, and by shuffles beyond them
        for module in (common, exact):
            monkeypatch.setattr(module, "BROADCAST_ROWS", -1)
            monkeypatch.setattr(module, "FILTER_KEYS", keys)
        monkeypatch.setattr("vigil.llm.token_counts.FILTER_KEYS", keys)
        for rows, frame in ((near, df), (edge_rows, edges), (edge_rows, clashing)):
            got = exact_groups(frame, keep="max").select("doc_id", "keep_id", "group_size", "kept").collect()
            assert sorted([tuple(r) for r in got], key=str) == brute_exact(rows, max)
        assert sorted([tuple(r) for r in token_counts(df, tokenizer, str(tmp_path / f"b{keys}")).collect()]) == plain
        assert spark.read.parquet(str(tmp_path / f"b{keys}")).count() == len({r[1] or "" for r in near})
        assert sorted([r.doc_id for r in drop_near(drop_exact(df, keep="max")).collect()]) == few
        assert drop_exact(clashing, keep="max").columns == clashing.columns


def test_filter(spark):
    import vigil.llm.common as common

    keys = spark.range(0, 30_000, 3).select((F.col("id") * 17).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("b"))
    every = spark.range(30_000).select((F.col("id") * 17).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("b"), F.lit("x").alias("bits"), F.lit("y").alias("word"))
    found, key = common.Filter(keys, keys.count()), [F.col("s.a"), F.col("s.b")]
    passing = found.joined(every.alias("s"), key, "f").where(found.passes(key, "f")).select("s.*")
    assert passing.columns == every.columns and passing.join(keys.select("a"), "a").count() == 10_000
    assert 10_000 <= passing.count() < 10_300


def test_only_repeated_texts_move(spark, monkeypatch):
    """Neither the rows to compare nor the rows to encode are shuffled before a filter; few others pass it."""
    import vigil.llm.common as common

    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    few = rows.where("doc_id % 100 = 0").select("doc_id")
    rest = rows.where("doc_id % 100 <> 0").select("doc_id")
    for df, least, most in ((common.holding(rows, few), 200, 320), (common.lacking(rows, rows, rest), 200, 205)):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        assert least <= df.count() <= most and df.join(few, "doc_id").count() == 200


def replaced(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def test_passage_recall_against_all_pairs(spark):
    """Pairs of texts with passages of 55 to 200 words of which 0 to 20% are replaced, others without: exactly those that
    share one by comparing all pairs of texts are linked, but for at most a tenth at each share of replaced words."""
    rng = random.Random(11)
    texts, share_of = [], {}
    for share in (0.0, 0.05, 0.1, 0.15, 0.2):
        for i in range(20):
            passage = fresh_words(rng, (55, 70, 100, 200)[i % 4])
            share_of[len(texts), len(texts) + 1] = share
            texts.append([*fresh_words(rng, 40), *passage, *fresh_words(rng, 40)])
            texts.append([*fresh_words(rng, 25), *replaced(rng, passage, int(share * len(passage))), *fresh_words(rng, 55)])
    texts += [fresh_words(rng, 120) for _ in range(40)]
    # Brute force: 50 or more words at the same places of two texts, shifted by any distance, of which four fifths are equal.
    where = defaultdict(list)
    for i, words in enumerate(texts):
        for at, w in enumerate(words):
            where[w].append((i, at))
    equal = defaultdict(lambda: defaultdict(list))
    for places in where.values():
        for i, p in places:
            for j, q in places:
                if i < j:
                    equal[i, j][p - q].append(p)
    passes = lambda at: any(5 * (j - i + 1) >= 4 * max(50, at[j] - at[i] + 1) for i in range(len(at) - 39) for j in range(i + 39, len(at)))
    true = {pair for pair, shifts in equal.items() for at in shifts.values() if passes(sorted(at))}
    got = {(min(r.doc_id, r.other_doc_id), max(r.doc_id, r.other_doc_id)) for r in repeated_passages(spark.createDataFrame(rows_of(" ".join(t) for t in texts), SCHEMA)).collect()}
    assert not got - true, got - true
    assert len(true) == 100
    for share in (0.0, 0.05, 0.1, 0.15, 0.2):
        own = {pair for pair in true if share_of[pair] == share}
        assert len(got & own) >= 0.9 * len(own), share


def test_passages_of_common_shingles(spark):
    """Every 6-word shingle of a passage of two texts occurs in twelve others as well."""
    rng = random.Random(12)
    texts, whole = [], []
    for _ in range(8):
        passage = fresh_words(rng, 60)
        whole.append((len(texts), len(texts) + 1))
        texts += [" ".join([*fresh_words(rng, 30), *passage, *fresh_words(rng, 40)]) for _ in range(2)]
        grams = [i for i in range(55) for _ in range(12)]
        rng.shuffle(grams)
        texts += [" ".join(w for i in grams[j::132] for w in [*fresh_words(rng, 8), *passage[i : i + 6]]) for j in range(132)]
    got = repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    assert {(min(r.doc_id, r.other_doc_id), max(r.doc_id, r.other_doc_id)) for r in got} == set(whole)


def test_passages_of_a_repeated_line_and_with_long_gaps(spark):
    """A passage is found whole where it is one line again and again, where a long gap is four fifths equal, and where words were put in."""
    rng = random.Random(13)
    line, start, gap, end, long = fresh_words(rng, 12), fresh_words(rng, 40), fresh_words(rng, 80), fresh_words(rng, 40), fresh_words(rng, 600)
    pairs = [
        (line * 20, line * 20), (start + gap + end, start + [w if i % 5 else f"x{i}" for i, w in enumerate(gap)] + end),
        (long, [w for i, w in enumerate(long) for w in ([w, f"y{i}"] if i % 29 == 7 else [w])]),
    ]
    texts = [" ".join([*fresh_words(rng, 30), *p, *fresh_words(rng, 200)]) for pair in pairs for p in pair]
    best = defaultdict(int)
    for r in repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA)).collect():
        best[min(r.doc_id, r.other_doc_id)] = max(best[min(r.doc_id, r.other_doc_id)], min(r.end - r.start, r.other_end - r.other_start))
    assert best.keys() == {0, 2, 4} and best[0] >= 238 and best[2] >= 158 and best[4] >= 590


def test_gap_matches_against_quadratic():
    import numpy as np

    from vigil.llm.substring_dedup import gap_matches

    rng = random.Random(14)
    for _ in range(1500):
        x = [rng.randrange(6) for _ in range(rng.randint(0, 30))]
        y = [w for w in x if rng.random() > 0.2] + [9] * rng.randint(0, 3) if rng.random() < 0.5 else [rng.randrange(6) for _ in range(rng.randint(0, 30))]
        row = [0] * (len(y) + 1)
        for u in x:
            left = 0
            for j, v in enumerate(y, 1):
                left, row[j] = row[j], left + 1 if u == v else max(row[j], row[j - 1])
        got = gap_matches(np.array(x, np.uint64), np.array(y, np.uint64))
        assert got == row[-1] or got <= row[-1] < 0.5 * max(len(x), len(y))


def test_passages_of_frequent_parts_edited(spark):
    """Passages of which every 6 words also occur in twelve or in ninety other texts, before and between those that hold them;
    5% of the second one's words are replaced. Both texts of each are linked."""
    rng = random.Random(14)
    texts, whole = [], []
    for i in range(16):
        passage, others = fresh_words(rng, 60), 90 if i % 4 == 0 else 12
        pair = [" ".join([*fresh_words(rng, 30), *p, *fresh_words(rng, 40)]) for p in (passage, replaced(rng, passage, 3))]
        grams = [i for i in range(55) for _ in range(others)]
        rng.shuffle(grams)
        n = 11 * others
        texts += [*pair, *(" ".join(w for i in grams[j::n] for w in [*fresh_words(rng, 8), *passage[i : i + 6]]) for j in range(n))]
        whole.append(frozenset(pair))
    rng.shuffle(texts)
    got = repeated_passages(spark.createDataFrame(rows_of(texts), SCHEMA).repartition(8)).collect()
    assert {frozenset((texts[r.doc_id], texts[r.other_doc_id])) for r in got} == set(whole)


def test_crowded_seeds_against_all_pairs():
    """What tile() links within and between blocks holds together what a comparison of all pairs of contexts does."""
    import numpy as np

    from vigil.llm.substring_dedup import Likeness, tile

    like, rng, n = Likeness(5, 50, 0.8), np.random.default_rng(3), 150
    for share, nx in ((0.05, n), (0.12, n), (0.18, n), (0.12, 70)):
        base = rng.integers(1, 1 << 16, (10, 90))[rng.integers(0, 10, n)]
        rows = np.where(rng.random((n, 90)) < share, rng.integers(1, 1 << 16, (n, 90)), base).astype(np.uint16)
        key, roots = np.sort(rng.permutation(2 * n)[:n] // 2), []
        a, b = np.nonzero(np.triu(np.ones((n, n), bool), 1) & (key[:, None] != key[None, :]))
        a, b = (a, b) if nx == n else (a[(a < nx) & (b >= nx)], b[(a < nx) & (b >= nx)])
        passes = np.array([any(np.count_nonzero(rows[p, s : s + 45] == rows[q, s : s + 45]) >= 35 for s in range(46)) for p, q in zip(a, b)])
        for links in (zip(a[passes], b[passes]), zip(*tile(key, rows, nx, like))):
            root = list(range(n))
            for p, q in links:
                old, new = root[p], root[q]
                root = [new if r == old else r for r in root]
            roots.append(root)
        assert len(set(zip(*roots))) == len(set(roots[0])) == len(set(roots[1]))


def test_crowded_seeds_compare_few_rows(monkeypatch):
    """Rows with a short line in common are compared only where they share more: not each with each. What is linked is the same
    as with all compared, between blocks too."""
    import numpy as np

    from vigil.llm import substring_dedup as module

    compared = []

    class Counting(module.Likeness):
        def unequal(self, *args, **kwargs):
            compared.append((out := super().unequal(*args, **kwargs)).size)
            return out

        def apart(self, *args):
            compared.append((out := super().apart(*args)).size)
            return out

    rng, n = np.random.default_rng(5), 4000
    rows = rng.integers(1, 1 << 16, (n, 90)).astype(np.uint16)
    rows[:, 40:50] = rows[0, 40:50]
    copies = rng.permutation(n)[:200].reshape(100, 2)
    for a, b in copies:
        rows[b] = np.where(rng.random(90) < 0.12, rows[b], rows[a])
    keys = np.arange(n)
    i, j = module.tile(keys, rows, n, Counting(5, 50, 0.8))
    assert sum(compared) < n * n / 20
    i, j = set(zip(i.tolist(), j.tolist())), {(min(x), max(x)) for x in copies.tolist()}
    assert i <= j and len(i) > 80
    # Half of the rows hold an edited boilerplate, so that only common stretches join them.
    rows[::2] = np.where(rng.random((n // 2, 90)) < 0.14, rows[::2], rows[0])
    for nx in (n, 1500):
        labels = []
        for indexed in (n, 50):
            monkeypatch.setattr(module, "INDEXED", indexed)
            a, b = module.tile(keys, rows, nx, module.Likeness(5, 50, 0.8))
            labels.append(module.forest(np.arange(n), a, b)[1].tolist())
        assert len(set(zip(*labels))) == len(set(labels[0])) == len(set(labels[1])) < n - 1000


def test_a_match_is_close_if_any_link_says_so():
    import pyarrow as pa

    from vigil.llm.substring_dedup import _chain

    links = pa.RecordBatch.from_pydict({"a": [2, 2], "a_pos": [7, 7], "b": [1, 1], "b_pos": [3, 3], "likely": [False, True]})
    assert sum(x.num_rows for x in _chain(5, 0.05)(iter([links]))) == 1
