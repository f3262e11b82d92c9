import random
from collections import Counter, defaultdict
from functools import cache

import pytest
from helpers import SCHEMA, rows_of, sentence

from vigil.llm import cross_align
from vigil.llm.cross_align import align, byte_level, pieces


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@cache
def libraries(paths):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    return a, b


def whole_ids(text, paths):
    """Whole texts by the libraries themselves, with the bytes of each token."""
    a, b = libraries(paths)
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    return ids_a, [byte_level(paths[0])[1][i] for i in ids_a], ids_b, [pieces(paths[1])[1][i] for i in ids_b]


def brute(rows, paths):
    seen, counts = [], Counter()
    for i, text, *_ in rows:
        groups, links = [], []
        if text:
            ids_a, bytes_a, ids_b, bytes_b = whole_ids(text, paths)
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = []
                for tokens in (bytes_a, bytes_b):
                    at, own = 0, []
                    for t in tokens:
                        at += len(t)
                        own.append(at)
                    ends.append(own)
                shared = set(ends[0]) & set(ends[1])
                by = defaultdict(lambda: ([], []))
                for side, ids in enumerate((ids_a, ids_b)):
                    g = 0
                    for token, end in zip(ids, ends[side]):
                        by[g][side].append(token)
                        g += end in shared
                groups = [by[g] for g in sorted(by)]
                other = dict(zip(ends[1], ids_b))
                links = [(x, other[e]) for x, e in zip(ids_a, ends[0]) if e in other]
        seen.append((i, groups, links))
        counts.update(links)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted([(
        i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
        ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups),
    ) for i, groups, links in seen], key=str)


def check(spark, rows, paths, df=None):
    got = align(df if df is not None else spark.createDataFrame(rows, SCHEMA), *paths).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, paths)


def test_edges(spark, edges, edge_rows, nothing, clashing, paths):
    check(spark, edge_rows, paths, edges)
    check(spark, edge_rows, paths, clashing)
    assert align(nothing, *paths).count() == 0


def test_random_texts(spark, paths, monkeypatch):
    monkeypatch.setattr(cross_align, "BLOCK_BYTES", 1500)
    rng = random.Random(8)
    alphabet = ["a", "b", "'s", "'", "1", "23", "é", "漢", "字", " ", " ", " ", "  ", "\n", "\t", " ", "　", "!", "...", "<|endoftext|>", "<s>", "<0x41>", "The", "\U0001f600", "\0", "́", "½", "▁", "İ", "ﬁ", "word", "\r"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    texts += [sentence(rng, rng.randint(1, 200)) for _ in range(60)] + ["the same words again"] * 40 + [" ", "  ", "\n", " x", "x ", "▁", "a ▁b"]
    check(spark, rows_of(texts), paths)


def test_all_code_points(spark, paths):
    points = [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    check(spark, rows_of(["".join(f"a{chr(c)} {chr(c)}1 " for c in points[i : i + 150]) for i in range(0, len(points), 150)]), paths)


def test_long_texts(spark, paths):
    rng = random.Random(9)
    check(spark, rows_of([" " * 100_000, "a" * 30_000, sentence(rng, 40_000), "漢" * 20_000, "x\n" * 20_000]), paths)


def test_tokenizers_that_do_not_suit(paths):
    import public_tokenizers

    with pytest.raises(ValueError):
        byte_level(public_tokenizers.path("word_bpe_49k.json"))
