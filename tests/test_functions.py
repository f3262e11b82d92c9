import datetime as dt
import json
import hashlib
import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil import sql
from vigil.functions import countries, dates, hashing, similarity, text


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


def plain_normal(v):
    if v is None:
        return None
    bare = "".join(c for c in unicodedata.normalize("NFD", v.strip()) if unicodedata.category(c) != "Mn")
    return " ".join(bare.split()).upper().strip() or None


TEXTS = [None, "", "   ", "Ñandú", "Łódź", "ß", "a 　b", "مح", "A & B", "S.A.S.", "  Ana   María\tde la Cruz ", "x\x1cy", "é", "İstanbul", "J. O'Neil-Smith"]


def test_text(spark):
    assert one(spark, TEXTS, text.normalize_text) == [plain_normal(t) for t in TEXTS]
    want = ["".join(c for c in n if c == " " or "A" <= c <= "Z").strip() or None if n else None for n in map(plain_normal, TEXTS)]
    assert one(spark, TEXTS, text.match_name) == want
    assert one(spark, ["12.345-6", "-", "", None, "ab c"], text.clean_document) == ["123456", "", None, None, "ABC"]
    names = spark.createDataFrame([("ACME", None), (None, None), ("A", "B")], "a string, b string")
    assert [r[0] for r in names.select(text.full_name(F.col("a"), F.col("b"))).collect()] == ["ACME", "", "A B"]
    assert [r[0] for r in names.select(text.full_name(F.col("a"), F.col("b"), "None")).collect()] == ["ACME None", "None None", "A B"]


def test_sql_functions(spark):
    sql.register(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    df.createOrReplaceTempView("texts_for_sql")
    got = spark.sql("SELECT v, normalize_text(v) AS n, match_name(v) AS m, clean_document(v) AS d FROM texts_for_sql").collect()
    want = df.select("v", text.normalize_text(F.col("v")), text.match_name(F.col("v")), text.clean_document(F.col("v"))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want)))
    assert abs(spark.sql("SELECT jaro_winkler('MARTHA', 'MARHTA')").first()[0] - 0.9611111) < 1e-6


DATES = {
    "2020-01-05": (2020, 1, 5), "2020-1-5": (2020, 1, 5), "05/06/2020": (2020, 6, 5), "12/31/2020": (2020, 12, 31), "31/02/2020": (2020, 1, 1), "05-06-2020": (2020, 6, 5), "20200506": (2020, 5, 6), "5  Jan 2020": (2020, 1, 5),
    "5 January 2020": (2020, 1, 5), "Jan 5, 2020": (2020, 1, 5), "january 5, 2020": (2020, 1, 5), "2020-07": (2020, 7, 1), "1999": (1999, 1, 1), "202011": (2020, 1, 1), "2020115": (2020, 11, 5), "2020130": (2020, 1, 30), "circa 1965": (1965, 1, 1),
    "2020-01-01T10:00:00": (2020, 1, 1), "n/a": None, "sin fecha": None, "": None, "hello": None, None: None, "20201315": None, " 2020-02-29 ": (2020, 2, 29), "2021-02-29": (2021, 1, 1),
}


def test_dates(spark):
    assert one(spark, list(DATES), dates.parse_date) == [dt.date(*d) if d else None for d in DATES.values()]
    assert one(spark, ["2020-05-06T10:00:00"], lambda c: dates.parse_date(c, datetimes=True)) == [dt.date(2020, 5, 6)]


def test_countries(spark):
    values = ["UK", "USA", "Colombia", "DEMOCRATIC REPUBLIC OF THE CONGO", "CONGO", "UNKNOWN", "N/A", "", "U", None, "Perú", "UNITED STATES OF AMERICA", "Nigeria (north)", "REPUBLICA", "N", "zz"]
    assert one(spark, values, countries.normalize_country) == ["UK", "US", "CO", "KP", "CO", None, None, None, "US", None, "PE", "US", "NG", "KR", "KP", "ZZ"]
    assert one(spark, ["Wakanda", "Peru"], lambda c: countries.normalize_country(c, strict=True)) == [None, "PE"]
    assert one(spark, ["Peru, Chile; N/A", None], countries.split_countries) == [["PE", "CL", "KP", "AF"], []]


def test_hash_is_that_of_json(spark):
    odd = [None, "", 'quo"te', "back\\slash", "tab\t", "line ", "Ñ", "\x01", "a/b"]
    rows = [{f: random.Random(i * 9 + k).choice(odd) for k, f in enumerate(hashing.HASHED)} for i in range(60)]
    df = spark.createDataFrame([tuple(r[f] for f in hashing.HASHED) for r in rows], ", ".join(f"{f} string" for f in hashing.HASHED))
    got = sorted(r[0] for r in df.select(hashing.content_hash()).collect())
    assert got == sorted(hashlib.sha256(json.dumps(r, sort_keys=True, ensure_ascii=False).encode()).hexdigest() for r in rows)
    got = spark.createDataFrame([("EU", "1", None)], "s string, i string, n string").select(hashing.record_id(F.col("s"), F.col("i"), F.col("n"))).first()[0]
    assert got == hashlib.sha256(b"EU|1|None").hexdigest()[:16]


NAMES = st.text("ABC DE", max_size=14).map(lambda s: s.strip())


@settings(max_examples=300, deadline=None)
@given(NAMES, NAMES)
def test_similarity_properties(a, b):
    assert 0 <= similarity.jaro(a, b) <= 1 and 0 <= similarity.jaro_winkler(a, b) <= 1 + 1e-12
    assert similarity.jaro_winkler(a, a) == 1.0
    assert similarity.name_similarity(a, b) >= (similarity.jaro_winkler(a, b) if a and b else 0)


def test_known_similarities():
    assert similarity.jaro("MARTHA", "MARHTA") == pytest.approx(0.944444, abs=1e-6)
    assert similarity.jaro("DIXON", "DICKSONX") == pytest.approx(0.766667, abs=1e-6)
    assert similarity.jaro_winkler("DWAYNE", "DUANE") == pytest.approx(0.84, abs=1e-6)
    assert similarity.jaro("ABC", "") == 0 and similarity.jaro("", "") == 1
    assert similarity.name_similarity("JUAN PEREZ", "PEREZ JUAN") == 1.0
    assert similarity.name_similarity("JUAN CARLOS PEREZ", "JUAN PEREZ") >= 0.95


def test_expression_and_bound_agree_with_udf(spark):
    rng = random.Random(4)
    name = lambda: " ".join("".join(rng.choice("ABCDEO") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 3)))
    pairs = [(name(), name()) for _ in range(1500)] + [("A  B", "A B"), ("", "A"), ("A", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    bound = similarity.could_reach(similarity.bound_columns(F.col("a")), similarity.bound_columns(F.col("b")), 0.8)
    for r in df.select("a", "b", similarity.name_similarity_udf()("a", "b").alias("u"), similarity.name_similarity_expr(F.col("a"), F.col("b")).alias("e"), bound.alias("may")).collect():
        assert r.u == pytest.approx(r.e, abs=1e-12), r
        assert r.may or r.u < 0.8


def test_similar_pairs_equal_all_pairs():
    """Every pair that reaches the threshold is found, with its similarity; long names and other letters too."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ABCDEO") for _ in range(rng.randint(1, 6)))
    x, y = ([" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(150)] + more for more in (["", "A", "A  B", "ABCD " * 14, "Ñandu x", "A" * 70], ["", "A", "A B", "ABCD " * 14, "Ñandu", "B" * 70]))
    x, y = sorted(set(x)), sorted(set(y))
    for least in (0.6, 0.8, 0.95):
        i, j, scores = similarity.similar_pairs(similarity.Forms(x), similarity.Forms(y), least)
        got = {(x[a], y[b]): s for a, b, s in zip(i, j, scores)}
        want = {(a, b): s for a in x for b in y if (s := similarity.name_similarity(a, b)) >= least}
        assert got.keys() == want.keys() and all(abs(got[k] - s) < 1e-12 for k, s in want.items())
    for some in ([], [""]):
        assert not len(similarity.similar_pairs(similarity.Forms(some), similarity.Forms(y), 0.5)[0])


def test_bound_is_one():
    rng = random.Random(6)
    names = sorted({" ".join("".join(rng.choice("ABEO") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 3))) for _ in range(200)})
    bound = similarity.most(similarity.Names(names), similarity.Names(names))
    assert all(bound[i, j] >= similarity.jaro_winkler(a, b) - 1e-6 for i, a in enumerate(names) for j, b in enumerate(names))
