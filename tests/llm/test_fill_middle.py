import hashlib
import random
import re

from helpers import SCHEMA, rows_of, sentence
from pyspark.sql import functions as F

from vigil.llm import fill_middle as fim

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(row, seed=42, fim_percent=50, spm_percent=80):
    text, h = row[1] or "", hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    u = UNITS.findall(text)
    n = len(u)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return row[0], n, "plain", None, None, text
    if h4 % 100 < spm_percent:
        return row[0], n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return row[0], n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(df, rows, **how):
    got = fim.fill_middle(df, **how).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted([brute(r, **how) for r in rows], key=str)
    by = {}
    for r in rows:
        by.setdefault(r[0], set()).add(r[1] or "")
    assert all(r.back in by[r.doc_id] for r in got)
    return got


def test_edges(spark, edges, edge_rows, nothing, clashing):
    check(edges, edge_rows)
    check(edges, edge_rows, fim_percent=100, spm_percent=50)
    check(clashing, edge_rows, fim_percent=100, spm_percent=0)
    assert fim.fill_middle(nothing).count() == 0


def test_random_texts_and_marks(spark):
    rng = random.Random(3)
    alphabet = ["a", "<", "P", "S", "M", ">", " ", "\n", "\t", "\x0b", "\x0c", "\r", "　", "é", "漢", "\U0001f600", "\0", " ", "<P>", "b c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["a<", "<S b P>", "x <S", "<P <S> y", " lead", "trail ", "  ", sentence(rng, 300)]
    rows = rows_of(texts)
    for how in ({}, {"fim_percent": 100, "spm_percent": 50, "seed": 7}):
        forms = {r.form for r in check(spark.createDataFrame(rows, SCHEMA), rows, **how)}
        assert forms == {"plain", "spm", "psm"}


def test_long_texts_in_slices(spark):
    """Texts longer than a slice, runs of one kind, and many rows a batch."""
    rng = random.Random(4)
    texts = ["ab cd " * 900_000, " " * 2_000_000, "x" * 2_000_000, "y " * 700_000 + " " * 100_000, *[sentence(rng, rng.randint(1, 3000)) for _ in range(400)], *["same text here"] * 500]
    rows = rows_of(texts)
    check(spark.createDataFrame(rows, SCHEMA).coalesce(1), rows, fim_percent=100)
