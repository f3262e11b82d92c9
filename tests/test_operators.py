import random

import pytest
from pyspark.sql import functions as F

from vigil.functions.similarity import jaro_winkler, name_similarity
from vigil.operators import monitoring, quality
from vigil.operators.cdc import SnapshotTable, change_counts, keep_last, upsert
from vigil.operators.screening import Settings, alert_counts, evaluate, evaluation_samples, score_summary, screen
from vigil.operators.synthetic import clean_parties, portfolio
from vigil.schemas import ALERT

TS = "2024-06-01 00:00:00"
PARTY = "id_tercero string, nombres string, apellidos string, numero_documento string, es_match_plantado int"
ENTRY = "id_registro string, fuente string, nombres string, apellidos string, numero_documento string, aliases array<string>, id_fuente_original string"


def parties(spark, rows):
    return spark.createDataFrame(rows, PARTY)


def entries(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], ENTRY)


def alerts(spark, p, e, **how):
    return {(r.id_tercero, r.id_registro): r for r in screen(parties(spark, p), entries(spark, e), Settings(**how), TS).collect()}


def test_documents(spark):
    p = [("1", "X", None, "12.345-6", 0), ("2", "X", None, "-", 0), ("3", "X", None, None, 0), ("4", None, None, "", 0)]
    e = [("a", "EU", None, None, "12 3456", []), ("b", "EU", None, None, "123456", []), ("c", "EU", None, None, ".", []), ("d", "EU", None, None, None, [])]
    got = alerts(spark, p, e)
    assert set(got) == {("1", "a"), ("1", "b"), ("2", "c")}
    assert all(r.tipo_match == "EXACTO_DOCUMENTO" and r.score_similitud == 1 and not r.requiere_revision for r in got.values())


def test_names_blocks_and_bands(spark):
    p = [("1", "JUAN", "PEREZ", None, 0), ("2", "PEREZ", "JUAN", None, 0), ("3", "Álvaro", "Ruiz", None, 0), ("4", None, "JUAN", None, 0), ("5", "JUAN", "PARDO", None, 0)]
    e = [("a", "EU", "JUAN", "PEREZ", None, []), ("b", "EU", "ALVARO", "RUIZ", None, []), ("c", "EU", None, "JUAN PEREZ", None, [])]
    got = alerts(spark, p, e)
    assert got["1", "a"].tipo_match == "EXACTO_NOMBRE" and got["2", "a"].tipo_match == "EXACTO_NOMBRE"
    assert ("3", "b") not in got and not any(k[0] == "4" or k[1] == "c" for k in got)
    assert got["5", "a"].requiere_revision and got["5", "a"].tipo_match == "FUZZY_NOMBRE"
    assert ("3", "b") in alerts(spark, p, e, normalize_block_key=True)
    assert ("5", "a") not in alerts(spark, p, e, low=0.99)


def test_missing_name_token(spark):
    p, e = [("1", "ACME CORP", None, None, 0)], [("a", "EU", "ACME CORP", None, None, [])]
    assert alerts(spark, p, e)["1", "a"].score_similitud == 1.0
    r = alerts(spark, p, e, null_name_token="None")["1", "a"]
    assert r.score_similitud == 0.9286 and r.tipo_match == "FUZZY_NOMBRE" and r.nombre_lista == "ACME CORP None"


def test_aliases_and_precedence(spark):
    p = [("1", "ROBERT", "SMITH", "77", 0)]
    e = [
        ("a", "EU", "ZED", None, None, ["ROBERTA", "ROBERT SMITH", "ROBERT SMYTH"]),  # the second one is the first to qualify
        ("b", "EU", "ROBERT", "SMALL", None, ["ROBERT SMITH"]),  # a name in the review band hides the alias
        ("c", "EU", "ROBERT", "SMITH", "77", ["ROBERT SMITH"]),  # the document hides both
        ("d", "EU", "QQ", None, None, ["ROB"]),
    ]
    got = alerts(spark, p, e, high=0.95, low=0.6)
    assert got["1", "a"].tipo_match == "ALIAS" and got["1", "a"].nombre_lista == "ROBERT SMITH" and not got["1", "a"].requiere_revision
    assert got["1", "b"].tipo_match == "FUZZY_NOMBRE" and got["1", "b"].requiere_revision
    assert got["1", "c"].tipo_match == "EXACTO_DOCUMENTO" and ("1", "d") not in got


def test_screen_against_loops(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("ABCO") for _ in range(rng.randint(2, 6)))
    p = [(str(i), word(), word() if rng.random() < 0.8 else None, str(rng.randint(1, 40)), 0) for i in range(60)]
    e = [(str(i), "EU", word(), word() if rng.random() < 0.7 else None, str(rng.randint(30, 90)), [f"{word()} {word()}" for _ in range(rng.randint(0, 3))]) for i in range(60)]
    want = {}
    for t in p:
        full = f"{t[1]} {t[2] or ''}".strip()
        for s in e:
            shown = f"{s[2]} {s[3] or ''}".strip()
            score = name_similarity(full, shown)
            alias = next((x for a in s[5] if (x := jaro_winkler(full, a)) >= 0.9), None) if any(a[:5] == full[:5] for a in s[5]) else None
            if t[3] == s[4]:
                want[t[0], s[0]] = ("EXACTO_DOCUMENTO", 1.0)
            elif s[2][0] in (t[1][0], (t[2] or t[1])[0]) and score >= 0.7:
                want[t[0], s[0]] = ("EXACTO_NOMBRE" if score >= 0.99 else "FUZZY_NOMBRE", round(score, 4))
            elif alias:
                want[t[0], s[0]] = ("ALIAS", round(alias, 4))
    for engine in ("arrow", "sql"):
        got = {k: (r.tipo_match, r.score_similitud) for k, r in alerts(spark, p, e, high=0.9, low=0.7, engine=engine).items()}
        assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1.1e-4 for k in got)
    monkeypatch.setattr("vigil.operators.screening.fits", lambda df: False)  # the shuffled, salted join
    assert {k: (r.tipo_match, r.score_similitud) for k, r in alerts(spark, p, e, high=0.9, low=0.7).items()} == got


def test_evaluation(spark):
    p = parties(spark, [("1", "a", "", "", 1), ("2", "a", "", "", 1), ("3", "a", "", "", 0)])
    a = spark.createDataFrame([("1", "x", "EU", "ALIAS", 0.95, "", "", False, None), ("3", "x", "UN", "ALIAS", 0.7, "", "", True, None)], ALERT)
    r = evaluate(a, p).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) == (1, 1, 1, 0.5, 0.5, 0.5)
    assert {tuple(x) for x in evaluation_samples(a, p).collect()} == {("missed", "2"), ("false_alarm", "3")}
    assert {tuple(x) for x in alert_counts(a).collect()} == {("tipo_match", "ALIAS", 2), ("fuente", "EU", 1), ("fuente", "UN", 1)}
    empty = score_summary(a.limit(0), 0.9, 0.6).first()
    assert (empty.total_alertas, empty.avg_score) == (0, 0.0) and evaluate(a.limit(0), p).first().precision == 0.0


STATE = "id_registro string, fuente string, tipo_sujeto string, nombres string, hash_contenido string, activo boolean, estado_carga string"
BATCH = "id_registro string, fuente string, tipo_sujeto string, nombres string, hash_contenido string, activo boolean, seq int"


def test_change_capture(spark):
    state = spark.createDataFrame([
        ("same", "EU", "T", "n", "h", True, "NUEVO"), ("mod", "EU", "T", "n", "h", True, "NUEVO"), ("gone", "EU", "T", "n", "h", True, "NUEVO"), ("back", "EU", "T", "n", "h", False, "ELIMINADO"),
        ("back2", "EU", "T", "n", "h", False, "ELIMINADO"), ("other", "UN", "T", "n", "h", True, "NUEVO"), ("dup", "EU", "T", "n", "h", True, "NUEVO")], STATE)
    batch = spark.createDataFrame([
        ("new", "EU", "B", "x", "h1", True, 1), ("same", "EU", "B", "x", "h", True, 2), ("mod", "EU", "B", "x", "h2", True, 3), ("back", "EU", "B", "x", "h", True, 4), ("back2", "EU", "B", "x", "h3", True, 5),
        ("dup", "EU", "B", "y", "h4", True, 6), ("dup", "EU", "B", "z", "h", True, 7), ("dup", "EU", "B", "w", "h", True, 8)], BATCH)
    counts = change_counts(batch, state).first()
    assert (counts.nuevos, counts.modificados, counts.sin_cambio, counts.eliminados) == (1, 4, 3, 1)  # though one that was deleted came back
    got = {r.id_registro: (r.tipo_sujeto, r.nombres, r.hash_contenido, r.activo, r.estado_carga) for r in upsert(batch, state).collect()}
    assert got == {
        "new": ("B", "x", "h1", True, "NUEVO"), "same": ("T", "n", "h", True, "NUEVO"), "mod": ("T", "x", "h2", True, "MODIFICADO"), "gone": ("T", "n", "h", False, "ELIMINADO"), "back": ("T", "n", "h", False, "ELIMINADO"),
        "back2": ("T", "x", "h3", True, "MODIFICADO"), "other": ("T", "n", "h", True, "NUEVO"), "dup": ("T", "z", "h", True, "MODIFICADO")}
    again = {r.id_registro: r.estado_carga for r in upsert(batch.limit(0), state).collect()}
    assert again["gone"] == "NUEVO"  # an empty batch deletes nothing
    revived = {r.id_registro: r.activo for r in upsert(batch, state, revive_unchanged=True).collect()}
    assert revived["back"]
    last = keep_last(batch, "id_registro", "seq").where("id_registro = 'dup'").collect()
    assert [r.nombres for r in last] == ["w"]


def test_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    assert t.read("a int").count() == 0
    t.commit(spark.range(3))
    t.commit(t.read().unionByName(spark.range(5)))
    assert t.versions() == [1, 2] and t.read().count() == 8


QUALITY = "id_registro string, fuente string, aliases array<string>, fecha_sancion date, hash_contenido string, id_fuente_original string, nombres string, apellidos string, activo boolean, seq int"


def test_quality(spark):
    import datetime as dt

    good = [(str(i), s, [], dt.date(2020, 1, 1), "h", str(i), "n", None, True, i) for i, s in enumerate(quality.SOURCES)]
    assert all(r.passed for r in quality.report(spark.createDataFrame(good, QUALITY), {"today": "2024-01-01"}).collect())
    bad = [("a", None, [], dt.date(2030, 1, 1), "h", "1", "", None, True, 1), ("b", "EU", [], None, "h1", "2", "n", None, None, 2), ("c", "EU", [], None, "h2", "2", "n", None, True, 3)]
    bad += [(f"d{i}", "EU", [], None, "h", f"x{i}", None, None, True, 4) for i in range(30)]
    lost = spark.createDataFrame([("t1", "nowhere", "EU", "ALIAS", 1.0, "", "", False, None)], ALERT)
    context = {"today": "2024-01-01", "alerts": lost, "parties": spark.createDataFrame([("t2",)], "id_tercero string")}
    got = {r.rule: r for r in quality.report(spark.createDataFrame(bad, QUALITY), context).collect()}
    n = {k: v.error_count for k, v in got.items()}
    assert n == {"fuente_no_nula": 1, "fuente_con_registros": 6, "aliases_como_lista": 0, "fecha_sancion_no_futura": 1, "hash_unico_por_fuente": 1, "alerta_referencias_validas": 2, "nombres_no_vacios": 31, "activo_es_booleano": 1}
    assert got["nombres_no_vacios"].capped_count == 20 and len(got["nombres_no_vacios"].errors_sample) == 5
    raw = spark.createDataFrame(bad[:1], QUALITY).withColumn("aliases", F.lit("{")).withColumn("activo", F.lit("maybe"))
    n = {r.rule: r.error_count for r in quality.report(raw).collect()}
    assert n["aliases_como_lista"] == 1 and n["activo_es_booleano"] == 1


def test_quality_reads_the_records_once(spark, tmp_path, monkeypatch):
    """One of the built-in rules' plans scans the records, the others what it leaves; a rule that fails leaves the others."""
    import datetime as dt

    rows = [(str(i), "EU", [], dt.date(2020, 1, 1), "h", str(i), "n" if i % 3 else None, None, True, i) for i in range(60)]
    spark.createDataFrame(rows, QUALITY).write.parquet(str(tmp_path / "records"))
    records, plans, write = spark.read.parquet(str(tmp_path / "records")), [], quality.staged

    def seen(df, name):
        plans.append([f for f in df.inputFiles() if f"{tmp_path}/records/" in f])
        return write(df, name)

    monkeypatch.setattr(quality, "staged", seen)
    got = {r.rule: r for r in quality.report(records, {"today": "2024-01-01", "expected_sources": ["EU"]}).collect()}
    assert sum(bool(p) for p in plans) == 1 and got["nombres_no_vacios"].error_count == 20

    def broken(records, context):
        raise ValueError("no such thing")

    late = quality.Rule("tarde", "fails while it runs", lambda r, c: r.select(F.raise_error(F.lit("late")).cast("string").alias("detail")))
    extra = [quality.Rule("rota", "fails when it is built", broken), late, quality.Rule("columna", "names a column that is missing", row=lambda r, c: (F.col("nowhere") > 0, [F.col("nowhere")]))]
    again = {r.rule: r for r in quality.report(records, {"today": "2024-01-01", "expected_sources": ["EU"]}, quality.RULES + extra).collect()}
    for name in ("rota", "tarde", "columna"):
        assert not again[name].passed and again[name].error_count == 1 and again[name].errors_sample[0].startswith("the rule failed")
    assert {k: v for k, v in again.items() if k in got} == got


def test_alert_rules_are_evaluated_apart(spark):
    rows = monitoring.metrics_frame(spark, {"pipeline_duration_seconds": 900, "avg_match_score": "no number", "records_per_source": {"EU": 0, "UN": "odd"}}, TS)

    def broken(metrics, now):
        return metrics.select(F.raise_error(F.lit("broken")))

    def unbuilt(metrics, now):
        raise ValueError("unbuilt")

    fired, failed = monitoring.evaluate_each(rows, TS, [broken, *monitoring.ALERT_RULES, unbuilt])
    assert {r.rule for r in fired.collect()} == {"LATENCIA_ALTA", "FUENTE_VACIA"}
    assert [f["rule"] for f in failed] == ["broken", "unbuilt"] and "unbuilt" in failed[1]["reason"]


def test_monitoring(spark):
    m = lambda values, ts=TS: monitoring.metrics_frame(spark, values, ts)
    fired = lambda x: {r.rule for r in monitoring.evaluate_alerts(x, TS).collect()}
    assert fired(monitoring.empty_metrics(spark)) == set()
    rates = m({"match_rate": 0.1}, "2024-05-30 00:00:00").unionByName(m({"match_rate": 0.15}))
    assert fired(rates) == set()  # exactly +50 %
    assert fired(rates.unionByName(m({"match_rate": 0.9}, "2024-06-02 00:00:00"))) == {"TASA_MATCHES_ANOMALA"}
    assert fired(m({"match_rate": 0.9})) == set()  # one sample
    assert fired(m({"records_per_source": {"EU": 0, "UN": 3}, "pipeline_duration_seconds": 600.0, "avg_match_score": 0.85})) == {"FUENTE_VACIA"}
    assert fired(m({"pipeline_duration_seconds": 600.1, "avg_match_score": 0.0, "last_successful_run_timestamp": "2024-05-28 00:00:00"})) == {"LATENCIA_ALTA", "SCORE_PROMEDIO_BAJO", "FUENTE_NO_ACTUALIZADA"}


def test_portfolio(spark):
    e = spark.createDataFrame([(f"r{i}", "EU", "PERSONA_NATURAL", f"NAME{chr(65 + i)} MIDDLE", "LAST FAMILY", ["ALIAS ONE", "ALIAS TWO"] if i % 2 else [], None, ["FR"], f"DOC{i}" if i % 3 else None) for i in range(20)] + [("short", "EU", "X", "AB", None, [], None, [], None)],
        "id_registro string, fuente string, tipo_sujeto string, nombres string, apellidos string, aliases array<string>, fecha_nacimiento date, nacionalidad array<string>, numero_documento string")
    rows, made = portfolio(e, 1000, 100)
    assert rows.count() == 1000 and rows.select("id_tercero").distinct().count() == 1000 and made.count() == 100
    kinds = {r[0]: r[1] for r in made.groupBy("tipo_match").count().collect()}
    assert kinds["TIPOGRAFICO"] == kinds["NOMBRE_PARCIAL"] == 20 and sum(kinds.values()) == 100
    assert made.where("id_registro_sancion = 'short'").count() == 0
    assert rows.exceptAll(portfolio(e, 1000, 100)[0]).count() == 0
    none, fallback = portfolio(e.limit(0), 100, 10)
    assert none.count() == 100 and fallback.where("id_registro_sancion = 'FALLBACK'").count() == 10
    people = clean_parties(spark, 5000).groupBy("tipo_sujeto").count().collect()
    assert 0.66 < {r[0]: r[1] for r in people}["PERSONA_NATURAL"] / 5000 < 0.74
    r = evaluate(screen(rows, e, Settings(), TS), rows).first()
    assert r.recall > 0.9


def test_metric_history_has_every_key(spark, tmp_path):
    from vigil.queries import metric_history

    rows = [(7 * k + i, f"2024-01-{1 + i:02d} 00:00:00", None if k == 120 else f"type{k}", float(i)) for k in range(121) for i in range(7)]
    events = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").selectExpr("event_id", "cast(ts AS timestamp) AS ts", "event_type", "value")
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = metric_history(spark, str(tmp_path)).collect()
    assert len({r.key for r in got}) == 121 and len(got) == 121 * 5 and {r.value for r in got} == {2.0, 3.0, 4.0, 5.0, 6.0}


def test_similar_names_in_tiles(spark, monkeypatch):
    """A key with most names, keys of one side only, nulls and repeated names; tiles of any size give the same pairs."""
    import random

    from vigil.functions.similarity import name_similarity
    from vigil.operators import name_join

    rng = random.Random(3)
    name = lambda: " ".join("".join(rng.choice("ABCEO") for _ in range(rng.randint(2, 5))) for _ in range(2))
    left = [("A" if rng.random() < 0.8 else rng.choice("BCD"), name()) for _ in range(120)] + [("A", None), (None, "AB AB"), ("Z", "AB AB"), ("A", "CO CO"), ("A", "CO CO")]
    right = [("A" if rng.random() < 0.8 else rng.choice("BCD"), name()) for _ in range(90)] + [("Y", "AB AB"), ("A", "CO CO"), (None, "AB")]
    want = {(k, a, b): round(name_similarity(a, b), 9) for k, a in left for q, b in right if k and a and b and k == q and name_similarity(a, b) >= 0.7}
    for tile, cores in ((4096, 8), (128, 8), (7, 10**6)):
        monkeypatch.setattr(name_join, "TILE", tile)
        monkeypatch.setattr(name_join, "LEAST_TILE", min(tile, 7))
        monkeypatch.setattr(name_join, "TILES_PER_CORE", cores)
        rows = name_join.similar_names(spark.createDataFrame(left, "key string, name string"), spark.createDataFrame(right, "key string, name string"), 0.7).collect()
        assert len(rows) == len(want) and {(r.key, r.l_name, r.r_name): round(r.score, 9) for r in rows} == want
    nothing = spark.createDataFrame([], "key string, name string")
    assert name_join.similar_names(nothing, spark.createDataFrame(right, "key string, name string"), 0.7).count() == 0


def test_alerts_are_not_shuffled(spark, monkeypatch):
    """Names of many rows in small tiles, documents that hide names, repeated ids; without those the alerts need no window."""
    from vigil.operators import name_join

    rng = random.Random(5)
    names = [(a, b) for a in ("ANA", "ANNA", "AL") for b in ("LOPEZ", "LOPES", "RUIZ")]
    p = [(f"p{k}", *(names[0] if k % 2 else rng.choice(names)), rng.choice(["1", "2", None]), 0) for k in range(60)]
    e = [(f"e{k}", "EU", *(names[1] if k % 3 else rng.choice(names)), rng.choice(["1", "3", None]), []) for k in range(40)]
    for name, value in (("TILE", 4), ("LEAST_TILE", 4), ("BEARERS", 3), ("PAIRS_AT_ONCE", 5)):
        monkeypatch.setattr(name_join, name, value)

    def check(p, e):
        want = {}
        for i, a, b, d, _ in p:
            for j, _, x, y, c, _ in e:
                score = round(name_similarity(f"{a} {b}", f"{x} {y}") + 1e-12, 4) if x[0] in (a[0], b[0]) else 0
                kind = (0, 1.0) if d == c and d else (1, -score) if score >= 0.8 else None
                if kind:
                    want[i, j] = min(want.get((i, j), kind), kind)
        got = screen(parties(spark, p), entries(spark, e), Settings(low=0.8), TS)
        rows = got.collect()
        assert len(rows) == len(want) and {(r.id_tercero, r.id_registro): (0, 1.0) if r.tipo_match == "EXACTO_DOCUMENTO" else (1, -r.score_similitud) for r in rows} == want
        return got._jdf.queryExecution().optimizedPlan().toString()

    assert "Window" not in check(p, e)
    assert "Window" in check(p + [("p1", "ANA", "RUIZ", "3", 0), ("p2", "AL", "RUIZ", None, 0)], e + [("e1", "EU", "ANA", "LOPEZ", "2", [])])


def test_equal_pairs_of_names_are_scored_once(spark, tmp_path):
    """Copies of a row, nulls and names that are equal only when normalised; scoring stands behind a grouping of the raw pairs."""
    from vigil import queries

    names = [("old ring", "RING OLD"), ("Old ring", "RING OLD"), ("hot bolt", "LARGE"), (None, "LARGE"), ("hot bolt", None), ("", "SMALL")]
    rows = [(100 * k + n, *pair) for n, pair in enumerate(names) for k in range(n + 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    got = queries.name_similarities(spark, str(tmp_path))
    scores = {r.p_partkey: (r.udf, r.expr) for r in got.collect()}
    want = {k: round(name_similarity((a or "").upper() or None, b), 9) for k, a, b in rows}
    assert len(scores) == len(rows) and {k: x for k, (x, _) in scores.items()} == want and all(abs(x - y) < 1e-9 for x, y in scores.values())
    assert "ArrowEvalPython" not in got._jdf.queryExecution().optimizedPlan().toString()
    bound = queries.similarity_bound(spark, str(tmp_path))
    assert tuple(bound.first()) == (0, len(rows))
    plan = bound._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [p_name" in plan[plan.index("ArrowEvalPython") :]


NARROW_STATE = "id_registro string, fuente string, nombres string, hash_contenido string, activo boolean, estado_carga string"


def test_bucket_state_writes_only_what_changes(spark, tmp_path):
    from vigil.operators.bucket_state import BucketState

    batch_of = lambda rows: spark.createDataFrame([(*r, True, k) for k, r in enumerate(rows)], "id_registro string, fuente string, nombres string, hash_contenido string, activo boolean, seq long")
    state = BucketState(spark, str(tmp_path / "s"), 16, NARROW_STATE)
    rows = [(f"i{k}", "A" if k % 2 else "B", f"n{k}", f"h{k}") for k in range(400)]
    assert state.read().count() == 0 and state.manifest() == {}
    first = state.merge(batch_of(rows))
    assert first.counts["nuevos"] == 400 and first.touched == list(range(16)) and state.versions() == [1]
    # The same again changes nothing, and makes no version.
    assert state.merge(batch_of(rows)).touched == [] and state.versions() == [1]
    # One modified, one missing (deleted): two buckets at most are written, the others' folders are taken over.
    changed = [("i7", "A", "new", "other"), *[r for r in rows if r[0] not in ("i7", "i8")]]
    before, draft = state.manifest(), state.merge(batch_of(changed))
    assert draft.counts == {"nuevos": 0, "modificados": 1, "sin_cambio": 398, "eliminados": 1} and 1 <= len(draft.touched) <= 2
    assert {b for b, path in state.manifest().items() if before[b] != path} == set(draft.touched)
    got = {r.id_registro: (r.nombres, r.estado_carga, r.activo) for r in state.read().collect()}
    assert len(got) == 400 and got["i7"] == ("new", "MODIFICADO", True) and got["i8"] == ("n8", "ELIMINADO", False)
    assert {r.id_registro for r in state.rows(draft, changed_only=True).collect()} == {"i7"}
    # Of one bucket only its own files are read.
    assert len(state.read([draft.touched[0]]).inputFiles()) < len(state.read().inputFiles()) and all(f"bucket={draft.touched[0]}/" in f for f in state.read([draft.touched[0]]).inputFiles())
    # An older version reads as it was; vacuum spares what is young, and what the kept versions name.
    assert state.read(version=1).where("estado_carga = 'NUEVO'").count() == 400
    assert state.vacuum(keep=1, grace_seconds=3600) == []
    gone = state.vacuum(keep=1, grace_seconds=0)
    assert {int(g.split("bucket=")[1]) for g in gone} == set(draft.touched) and state.versions() == [2] and state.read().count() == 400
    # Of two drafts on one version one is published.
    drafts = [state.stage(batch_of([("x", "C", "x", h)])) for h in ("1", "2")]
    state.publish(drafts[0])
    with pytest.raises(RuntimeError):
        state.publish(drafts[1])
    assert state.read().where("id_registro = 'x'").first().hash_contenido == "1"
    with pytest.raises(ValueError):
        BucketState(spark, str(tmp_path / "s"), 8, NARROW_STATE).read()


def test_bucket_state_equals_whole_merges(spark, tmp_path):
    """Any sequence of batches, with repeated ids, deletions and returns, ends as a merge of the whole state would."""
    import random

    from vigil.operators.bucket_state import BucketState

    rng = random.Random(2)
    schema = "id_registro string, fuente string, nombres string, hash_contenido string, activo boolean, seq long"
    for revive in (False, True):
        state, whole = BucketState(spark, str(tmp_path / f"s{revive}"), 5, NARROW_STATE), spark.createDataFrame([], NARROW_STATE)
        for turn in range(4):
            ids = [f"i{rng.randint(0, 30)}" for _ in range(rng.choice([3, 25]))]
            rows = [(i, "A" if int(i[1:]) % 2 else "B", f"n{turn}", rng.choice("xyz"), True, k) for k, i in enumerate(ids)]
            batch = spark.createDataFrame(rows, schema)
            counts = change_counts(batch, whole, revive_unchanged=revive).first().asDict()
            whole = spark.createDataFrame(upsert(batch, whole, revive_unchanged=revive).collect(), NARROW_STATE)
            assert state.merge(batch, revive_unchanged=revive).counts == counts
            assert sorted(map(tuple, state.read().collect())) == sorted(map(tuple, whole.select(*state.read().columns).collect()))


def test_lineage_is_joined_once_a_run(spark, tmp_path, monkeypatch):
    from vigil.schemas import ALERT as SCHEMA

    history = monitoring.AlertHistory(spark, str(tmp_path / "h"))
    alert = lambda t, r: spark.createDataFrame([(t, r, "EU", "ALIAS", 0.9, "n", "m", False, None)], SCHEMA)
    people, list_ = parties(spark, [("t", "A", "B", "1", 0)]), entries(spark, [("r", "EU", "A", "B", "1", [])])
    assert history.read().count() == 0 and history.refresh(list_, people) == []
    history.store(alert("t", "r"), "2024-06-01 00:00:00")
    assert history.refresh(list_, people) == ["2024-06-01-00-00-00"] and history.refresh(list_, people) == []
    history.store(alert("gone", "r"), "2024-06-02 00:00:00")
    # A later refresh joins the new run alone, so the older one keeps what was on record.
    assert history.refresh(list_.withColumn("nombres", F.lit("renamed")), people) == ["2024-06-02-00-00-00"]
    got = {r.run_id: (r.sancion_nombres, r.tercero_id) for r in history.read().collect()}
    assert got == {"2024-06-01-00-00-00": ("A", "t"), "2024-06-02-00-00-00": ("renamed", None)}
    # A run whose view was left half written is joined again.
    (tmp_path / "h" / "lineage" / "run_id=2024-06-02-00-00-00" / "_SUCCESS").unlink()
    assert history.runs("lineage") == ["2024-06-01-00-00-00"] and history.refresh(list_, people) == ["2024-06-02-00-00-00"] and history.read().count() == 2


def test_tiles_give_numbers_and_rows_meet_them_later(spark, monkeypatch):
    """Names of many rows, in tiles and columns of a few names, repeated and missing keys; no text of a pair leaves a tile, and what isn't used isn't read."""
    from vigil.functions import similarity
    from vigil.operators import name_join

    for module, name, value in ((name_join, "TILE", 4), (name_join, "LEAST_TILE", 4), (name_join, "BEARERS", 3), (name_join, "PAIRS_AT_ONCE", 5), (similarity, "WIDE", 3), (similarity, "IN_ORDER", 2), (similarity, "KEPT", 6)):
        monkeypatch.setattr(module, name, value)
    rng = random.Random(7)
    names = ["ANA LOPEZ", "ANNA LOPEZ", "LOPEZ ANA", "AL", "ALA RUIZ", "A" * 40 + " LOPEZ", "ANA " + "LOPEZ " * 12 + "X", "", None]
    left = [(rng.choice([["A"], ["A", "L"], ["B"], None]), rng.choice(names), f"p{k}", "t") for k in range(70)]
    right = [([rng.choice("AL")], rng.choice(names), f"e{k}") for k in range(50)]
    want = {(p, e): name_similarity(a, b) for ks, a, p, _ in left for (key,), b, e in right if ks and key in ks and a and b and name_similarity(a, b) >= 0.7}
    got = name_join.similar_rows(spark.createDataFrame(left, "keys array<string>, name string, p string, unused string"), spark.createDataFrame(right, "keys array<string>, name string, e string"), 0.7)
    rows = got.collect()
    assert len(rows) == len(want) and {(r.p, r.e): pytest.approx(r.score, abs=1e-12) for r in rows} == want
    plan = got.select("score").groupBy().sum()._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Relation" not in line]
    assert not any("unused" in line for line in lines) and any("FlatMapGroupsInArrow" in line and "l_unit" in line and "r_unit" in line for line in lines)
