"""Queries of the screening operators over the standard tables, and the SQL that DuckDB runs for each.

The portfolio is all of documents (names are the first words of a text), the list all of conversations.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.countries import COUNTRIES, normalize_countries, normalize_country, prefixes
from .functions.dates import parse_date
from .functions.hashing import content_hash, record_id
from .functions.similarity import bound_columns, could_reach, name_similarity_expr, name_similarity_udf
from .functions.text import match_name, normalize_text
from .operators import monitoring, quality
from .operators.bucket_state import BucketState
from .operators.cdc import COUNTS, change_counts, keep_last, merge, upsert
from .operators.joins import checked
from .operators.screening import Settings, alert_counts, evaluate, index_sizes, score_summary, screen
from .operators.synthetic import portfolio
from .packaging import ship
from .plans.run import ingest_all, read_parties, save_csv, save_report
from .sources.canonical import canonical
from .sources.delimited import delimited, read_delimited
from .sources.files import debarred
from .sources.hits import read_hits
from .sources.pages import register as register_pages
from .sources.xml_lists import read_eu, read_sdn, read_un
from .staging import fresh_path, staged
from .streaming.changes import write_changes
from .streaming.incremental import event_windows

RUN_TS = "2024-06-01 12:00:00"
SETTINGS = Settings(high=0.92, low=0.80)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _landing(spark: SparkSession, name: str) -> str:
    return fresh_path(spark, f"landing-{name}")


# The portfolio and the list

WORDS = r"[^\x20\x09-\x0D]+"


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), F.lit(0))
    x = table(spark, sf_dir, "documents").withColumn("w", w)
    name = F.nullif(F.concat_ws(" ", F.get("w", 1), F.get("w", 2)), F.lit(""))
    return x.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id_tercero"), F.lit("PERSONA_NATURAL").alias("tipo_sujeto"), F.get("w", 0).alias("nombres"), name.alias("apellidos"),
        F.concat_ws("-", (F.col("doc_id") % 977).cast("string"), F.col("lang")).alias("numero_documento"), F.when(F.col("lang") == "en", 1).otherwise(0).alias("es_match_plantado"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), F.lit(0))
    x = table(spark, sf_dir, "conversations").withColumn("w", w)
    name = F.nullif(F.concat_ws(" ", F.get("w", 1), F.get("w", 2)), F.lit(""))
    return x.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id_registro"), F.col("role").alias("fuente"), F.get("w", 0).alias("nombres"), name.alias("apellidos"),
        F.array(F.concat_ws(" ", F.get("w", 3), F.get("w", 4)), F.concat_ws(" ", F.get("w", 0), F.get("w", 1), F.get("w", 3))).alias("aliases"),
        F.concat(((F.col("conv_id") * 31 + F.col("turn")) % 997).cast("string"), F.lit(". EN")).alias("numero_documento"), F.col("conv_id").cast("string").alias("id_fuente_original"),
    )


# The same in SQL

_FOLD = "upper(replace(strip_accents({0}), 'ß', 'ss'))"


def _normal(x: str) -> str:
    return f"nullif(trim(regexp_replace({_FOLD.format(x)}, '\\s+', ' ', 'g')), '')"


def _match(x: str) -> str:
    return f"nullif(trim(regexp_replace({_normal(x)}, '[^A-Z ]', '', 'g')), '')"


PEOPLE = f"""
    dw AS (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    people AS (SELECT 'D' || doc_id AS id_tercero, w[1] AS nombres, nullif(concat_ws(' ', w[2], w[3]), '') AS apellidos, concat_ws('-', doc_id % 977, lang) AS numero_documento,
                      lang = 'en' AS planted FROM dw),
    cw AS (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM conversations),
    listed AS (SELECT conv_id || '-' || turn AS id_registro, role AS fuente, w[1] AS nombres, nullif(concat_ws(' ', w[2], w[3]), '') AS apellidos,
                      [concat_ws(' ', w[4], w[5]), concat_ws(' ', w[1], w[2], w[4])] AS aliases, ((conv_id * 31 + turn) % 997) || '. EN' AS numero_documento, conv_id::VARCHAR AS id_fuente_original FROM cw)
"""


def _jw(pairs: str) -> str:
    """CTE jw (a, b, jw): Jaro-Winkler of the distinct pairs of non-empty names in `pairs`. Matched letters of b are overwritten with '#', left to right."""
    reach = "greatest(0, greatest(len(a), len(b)) // 2 - 1)"
    low = f"greatest(1, e.i - {reach})"
    at = f"instr(substr(s.v, {low}, e.i + {reach} - {low} + 1), substr(a, e.i, 1))"
    same = " ".join(f"WHEN least(len(a), len(b)) >= {k} AND substr(a, 1, {k}) = substr(b, 1, {k}) THEN {k}" for k in (4, 3, 2, 1))
    return f"""
    jw_pairs AS (SELECT DISTINCT a, b FROM {pairs}),
    jw_fold AS (SELECT a, b, list_reduce(list_transform(range(1, len(a) + 1), lambda i: {{'i': i, 'v': '', 'm': ''}}),
        lambda s, e: CASE WHEN {at} > 0 THEN {{'i': e.i, 'v': substr(s.v, 1, {low} + {at} - 2) || '#' || substr(s.v, {low} + {at}), 'm': s.m || substr(a, e.i, 1)}}
                     ELSE {{'i': e.i, 'v': s.v, 'm': s.m}} END, {{'i': 0::BIGINT, 'v': b, 'm': ''}}) AS s FROM jw_pairs),
    jw_met AS (SELECT a, b, s.m AS m, array_to_string(list_transform(range(1, len(b) + 1), lambda i: CASE WHEN substr(s.v, i, 1) = '#' THEN substr(b, i, 1) ELSE '' END), '') AS n FROM jw_fold),
    jw_jaro AS (SELECT a, b, CASE WHEN a = b THEN 1.0::DOUBLE WHEN len(m) = 0 THEN 0.0::DOUBLE
        ELSE (len(m) / len(a) + len(m) / len(b) + (len(m) - len(list_filter(range(1, len(m) + 1), lambda i: substr(m, i, 1) <> substr(n, i, 1))) / 2) / len(m)) / 3 END AS j FROM jw_met),
    jw AS (SELECT a, b, j + (CASE {same} ELSE 0 END)::DOUBLE * 0.1::DOUBLE * (1 - j) AS jw FROM jw_jaro)"""


_SPLIT = "list_filter(string_split({0}, ' '), lambda x: x <> '')"


def _similarity(pairs: str) -> str:
    """CTEs up to `name_scores` (a, b, score) for the distinct pairs (a, b) in `pairs`."""
    return f"""
    n_pairs AS (SELECT DISTINCT a, b, {_SPLIT.format('a')} AS x, {_SPLIT.format('b')} AS y FROM {pairs}),
    n_forms AS (SELECT a, b, CASE WHEN len(x) > 1 OR len(y) > 1 THEN array_to_string(list_reverse(x), ' ') END AS r,
                       CASE WHEN len(x) > 1 AND len(y) > 1 THEN x[1] || ' ' || x[-1] END AS oa, CASE WHEN len(x) > 1 AND len(y) > 1 THEN y[1] || ' ' || y[-1] END AS ob FROM n_pairs),
    n_all AS (SELECT a, b FROM n_forms UNION SELECT r, b FROM n_forms WHERE r IS NOT NULL UNION SELECT oa, ob FROM n_forms WHERE oa IS NOT NULL),
    {_jw('n_all')},
    name_scores AS (SELECT f.a, f.b, greatest(d.jw, coalesce(t.jw, 0), coalesce(0.95::DOUBLE * o.jw, 0)) AS score
                FROM n_forms f JOIN jw d ON d.a = f.a AND d.b = f.b LEFT JOIN jw t ON t.a = f.r AND t.b = f.b LEFT JOIN jw o ON o.a = f.oa AND o.b = f.ob)"""


def _screen_sql(high: float, low: float) -> str:
    clean = "regexp_replace(upper({0}), '[\\s\\-.]', '', 'g')"
    return f"""
    {PEOPLE},
    p AS (SELECT *, trim(coalesce(nombres, '') || ' ' || coalesce(apellidos, '')) AS full_name FROM people),
    pn AS (SELECT *, {_match('full_name')} AS name, {clean.format('numero_documento')} AS doc FROM p),
    l AS (SELECT *, trim(coalesce(nombres, '') || ' ' || coalesce(apellidos, '')) AS full_name FROM listed),
    ln AS (SELECT *, {_match('full_name')} AS name, {clean.format('numero_documento')} AS doc, upper(substr(nombres, 1, 1)) AS key FROM l),
    by_doc AS (SELECT id_tercero, id_registro, fuente, 'EXACTO_DOCUMENTO' AS tipo_match, 1.0 AS score, pn.full_name AS nombre_tercero, ln.full_name AS nombre_lista, false AS requiere_revision, 0 AS stage
               FROM pn JOIN ln ON pn.doc = ln.doc WHERE pn.numero_documento <> '' AND ln.numero_documento <> ''),
    keys AS (SELECT id_tercero, upper(substr(nombres, 1, 1)) AS key FROM pn WHERE nombres <> ''
             UNION SELECT id_tercero, upper(substr(apellidos, 1, 1)) FROM pn WHERE nombres <> '' AND apellidos <> ''),
    blocked AS (SELECT pn.id_tercero, id_registro, fuente, pn.full_name AS t_full, ln.full_name AS l_full, pn.name AS a, ln.name AS b
                FROM keys JOIN pn USING (id_tercero) JOIN ln ON ln.key = keys.key WHERE pn.name IS NOT NULL AND ln.name IS NOT NULL),
    aliased AS (SELECT pn.id_tercero, pn.full_name AS t_full, pn.name AS a, ln.id_registro, fuente, i, aliases[i] AS raw, {_match('aliases[i]')} AS b
                FROM (SELECT *, unnest(range(1, len(aliases) + 1)) AS i FROM ln) ln JOIN pn ON pn.name IS NOT NULL
                     AND substr(pn.name, 1, 5) IN (SELECT substr({_match('x')}, 1, 5) FROM (SELECT unnest(ln.aliases) AS x))),
    need AS (SELECT a, b FROM blocked UNION SELECT a, b FROM aliased WHERE b IS NOT NULL),
    {_similarity('need')},
    by_name AS (SELECT id_tercero, id_registro, fuente, CASE WHEN score >= greatest(0.99, {high}) THEN 'EXACTO_NOMBRE' ELSE 'FUZZY_NOMBRE' END AS tipo_match, score, t_full AS nombre_tercero, l_full AS nombre_lista,
                       score < {high} AS requiere_revision, 1 AS stage FROM blocked JOIN name_scores USING (a, b) WHERE score >= {low}),
    by_alias AS (SELECT id_tercero, id_registro, fuente, 'ALIAS' AS tipo_match, jw AS score, t_full AS nombre_tercero, raw AS nombre_lista, jw < 0.99 AS requiere_revision, 2 AS stage
                 FROM aliased JOIN jw USING (a, b) WHERE jw >= {high} QUALIFY row_number() OVER (PARTITION BY id_tercero, id_registro ORDER BY i) = 1),
    found AS (SELECT * FROM by_doc UNION ALL SELECT * FROM by_name UNION ALL SELECT * FROM by_alias),
    alerts AS (SELECT id_tercero, id_registro, fuente, tipo_match, round(score::VARCHAR::DECIMAL(38, 20), 4)::DOUBLE AS score_similitud, nombre_tercero, nombre_lista, requiere_revision
               FROM found QUALIFY row_number() OVER (PARTITION BY id_tercero, id_registro ORDER BY stage, score DESC) = 1)"""


ALERTS = _screen_sql(SETTINGS.high, SETTINGS.low)
#: The thresholds of a production run.
WIDE = Settings(high=0.92, low=0.60)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# Normalisers


@query(f"SELECT doc_id, md5({_normal('text')}) AS normal, md5({_match('text')}) AS matchable FROM documents")
def normalize_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(normalize_text(F.col("text"))).alias("normal"), F.md5(match_name(F.col("text"))).alias("matchable"))


#: Forms of a date (Spark's and DuckDB's patterns), one for each remainder of the order's key.
DATE_FORMS = [
    ("yyyy-MM-dd", "%Y-%m-%d"), ("dd/MM/yyyy", "%d/%m/%Y"), ("MM/dd/yyyy", "%m/%d/%Y"), ("dd-MM-yyyy", "%d-%m-%Y"), ("yyyyMMdd", "%Y%m%d"), ("dd MMM yyyy", "%d %b %Y"), ("dd MMMM yyyy", "%d %B %Y"),
    ("MMM dd, yyyy", "%b %d, %Y"), ("MMMM dd, yyyy", "%B %d, %Y"), ("yyyy-MM", "%Y-%m"), ("yyyy", "%Y"), ("'circa' yyyy", "circa %Y"), ("yyyy-MM-dd'T'HH:mm", "%Y-%m-%dT%H:%M"),
]
_tries = ", ".join(f"try_strptime(v, '{f}')" for _, f in DATE_FORMS[:11])


@query(f"""
    WITH r AS (SELECT o_orderkey, CASE o_orderkey % {len(DATE_FORMS)} {' '.join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, (_, f) in enumerate(DATE_FORMS))} END AS v FROM orders)
    SELECT o_orderkey, v, coalesce({_tries}, try_strptime(nullif(regexp_extract(v, '(19|20)\\d{{2}}'), ''), '%Y'))::DATE AS d FROM r""")
def parse_dates(spark, sf_dir):
    form = F.lit(None).cast("string")
    for i, (pattern, _) in enumerate(DATE_FORMS):
        form = F.when(F.col("o_orderkey") % len(DATE_FORMS) == i, F.date_format("o_orderdate", pattern)).otherwise(form)
    return table(spark, sf_dir, "orders").select("o_orderkey", form.alias("v")).withColumn("d", parse_date(F.col("v")))


COUNTRY_TEXTS = ["Colombia", "usa", "UK", "Democratic Republic of the Congo", "CONGO", "Unknown", "N/A", "", "U", "Perú", "  venezuela ", "Republic of Korea", "Wakanda", "United Arab Emirates", "x1"]
_country_in = "CASE c_custkey % {0} {1} END".format(len(COUNTRY_TEXTS), " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(COUNTRY_TEXTS)))
_known = ", ".join("('{0}', {1})".format(k.replace("'", "''"), f"'{v}'" if v else "NULL") for k, v in COUNTRIES.items())
_begins = ", ".join("('{0}', {1})".format(k.replace("'", "''"), f"'{v}'" if v else "NULL") for k, v in prefixes().items())


@query(f"""
    WITH known(name, code) AS (VALUES {_known}), begins(name, code) AS (VALUES {_begins}),
    t AS (SELECT c_custkey, {_country_in} AS v FROM customer), u AS (SELECT *, upper(trim(v)) AS x, {_normal('upper(trim(v))')} AS n FROM t)
    SELECT c_custkey, CASE WHEN x = '' THEN NULL WHEN regexp_full_match(x, '\\p{{L}}{{2}}') THEN x WHEN k.name IS NOT NULL THEN k.code WHEN b.name IS NOT NULL THEN b.code
                           WHEN len(x) >= 2 THEN substr(x, 1, 2) END AS country
    FROM u LEFT JOIN known k ON k.name = n LEFT JOIN begins b ON b.name = substr(n, 1, 4)""")
def normalize_country_names(spark, sf_dir):
    text = F.get(F.array(*[F.lit(t) for t in COUNTRY_TEXTS]), (F.col("c_custkey") % len(COUNTRY_TEXTS)).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", normalize_country(text).alias("country"))


_js = "coalesce(to_json({0})::VARCHAR, 'null')"


@query(f"""
    WITH r AS (SELECT doc_id, source AS fuente, lang AS tipo_sujeto, text AS nombres, nullif(lang, 'en') AS apellidos, n_chars::VARCHAR AS numero_documento FROM documents)
    SELECT doc_id, substr(sha256(fuente || '|' || doc_id || '|' || coalesce(nombres, 'None')), 1, 16) AS id_registro,
           sha256('{{"apellidos": ' || {_js.format('apellidos')} || ', "fecha_nacimiento": null, "fecha_sancion": "2020-01-31", "fuente": ' || {_js.format('fuente')} || ', "nombres": ' || {_js.format('nombres')} ||
                  ', "numero_documento": ' || {_js.format('numero_documento')} || ', "tipo_sancion": null, "tipo_sujeto": ' || {_js.format('tipo_sujeto')} || '}}') AS hash_contenido FROM r""")
def record_hashes(spark, sf_dir):
    x = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("fuente"), F.col("lang").alias("tipo_sujeto"), F.col("text").alias("nombres"), F.nullif("lang", F.lit("en")).alias("apellidos"), F.lit(None).cast("date").alias("fecha_nacimiento"),
        F.col("n_chars").cast("string").alias("numero_documento"), F.lit(None).cast("string").alias("tipo_sancion"), F.lit("2020-01-31").cast("date").alias("fecha_sancion"))
    return x.select("doc_id", record_id(F.col("fuente"), F.col("doc_id"), F.col("nombres")).alias("id_registro"), content_hash().alias("hash_contenido"))


# Similarity


@query(f"WITH src AS (SELECT p_partkey, {_match('p_name')} AS a, {_match('p_type')} AS b FROM part), {_similarity('src')} SELECT p_partkey, round(score, 9) AS udf, round(score, 9) AS expr FROM src JOIN name_scores USING (a, b)")
def name_similarities(spark, sf_dir):
    """Every distinct pair of raw names is normalised and scored once, in tasks of few pairs, and joined back to the rows that have it."""
    ship(spark)
    x = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    pairs = _spread(x.select("p_name", "p_type").distinct()).select(F.col("p_name").alias("name"), F.col("p_type").alias("type"), match_name(F.col("p_name")).alias("a"), match_name(F.col("p_type")).alias("b"))
    scored = staged(pairs.select("name", "type", F.round(name_similarity_udf()("a", "b"), 9).alias("udf"), F.round(name_similarity_expr(F.col("a"), F.col("b")), 9).alias("expr")), "name-pairs")
    return x.join(checked(scored), F.col("p_name").eqNullSafe(F.col("name")) & F.col("p_type").eqNullSafe(F.col("type"))).select("p_partkey", "udf", "expr")


def _spread(df: DataFrame) -> DataFrame:
    """Rows of few bytes and much work, dealt over as many tasks as there are cores; a number of its own keeps small ones apart."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


@query("SELECT 0::BIGINT AS lost, count(*) AS pairs FROM part")
def similarity_bound(spark, sf_dir):
    """Pairs that the bound would drop although they reach the threshold: none. A pair counts for every row that has it, and is tested once."""
    ship(spark)
    n = _spread(table(spark, sf_dir, "part").groupBy("p_name", "p_type").agg(F.count(F.lit(1)).alias("n")))
    x = n.select("n", match_name(F.col("p_name")).alias("a"), match_name(F.col("p_type")).alias("b"))
    x = x.select("n", name_similarity_udf()("a", "b").alias("s"), could_reach(bound_columns(F.col("a")), bound_columns(F.col("b")), 0.6).alias("may"))
    return x.agg(F.coalesce(F.sum(F.when((F.col("s") >= 0.6) & ~F.col("may"), F.col("n"))), F.lit(0).cast("long")).alias("lost"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("pairs"))


# Screening


def _alerts(spark, sf_dir):
    return screen(parties(spark, sf_dir), entries(spark, sf_dir), SETTINGS, RUN_TS)


@query(f"WITH {ALERTS} SELECT * FROM alerts")
def screen_portfolio(spark, sf_dir):
    return _alerts(spark, sf_dir).drop("timestamp")


@query(f"WITH {_screen_sql(WIDE.high, WIDE.low)} SELECT * FROM alerts")
def screen_portfolio_wide(spark, sf_dir):
    """At the command's default thresholds, some fifteen times as many alerts."""
    return screen(parties(spark, sf_dir), entries(spark, sf_dir), WIDE, RUN_TS).drop("timestamp")


@query(f"""WITH {ALERTS} SELECT count(*) AS total_alertas, coalesce(min(score_similitud), 0) AS min_score, coalesce(max(score_similitud), 0) AS max_score, round(coalesce(avg(score_similitud), 0), 6) AS avg_score,
    count(*) FILTER (score_similitud >= {SETTINGS.high}) AS count_high, count(*) FILTER (score_similitud >= {SETTINGS.low} AND score_similitud < {SETTINGS.high}) AS count_gray FROM alerts""")
def screening_scores(spark, sf_dir):
    return score_summary(_alerts(spark, sf_dir), SETTINGS.high, SETTINGS.low).withColumn("avg_score", F.round("avg_score", 6))


@query(f"WITH {ALERTS} SELECT 'tipo_match' AS dimension, tipo_match AS value, count(*) AS n FROM alerts GROUP BY ALL UNION ALL SELECT 'fuente', fuente, count(*) FROM alerts GROUP BY ALL")
def screening_counts(spark, sf_dir):
    return alert_counts(_alerts(spark, sf_dir))


@query(f"""WITH {ALERTS}, g AS (SELECT id_tercero, planted, id_tercero IN (SELECT id_tercero FROM alerts) AS alerted FROM people),
    n AS (SELECT count(*) FILTER (planted AND alerted) AS tp, count(*) FILTER (NOT planted AND alerted) AS fp, count(*) FILTER (planted AND NOT alerted) AS fn FROM g),
    r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM n)
    SELECT tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1 FROM r""")
def screening_evaluation(spark, sf_dir):
    return evaluate(_alerts(spark, sf_dir), parties(spark, sf_dir))


_urls = ", ".join(f"('{k}', '{v}')" for k, v in monitoring.SOURCE_URLS.items())


_LINEAGE = f"""WITH {ALERTS}, urls(s, u) AS (VALUES {_urls})
    SELECT a.id_tercero, a.id_registro, a.tipo_match, a.score_similitud AS score, p.id_tercero AS tercero_id, trim(concat_ws(' ', p.nombres, p.apellidos)) AS tercero_nombre, p.numero_documento AS tercero_documento,
           l.id_registro AS sancion_id, l.nombres AS sancion_nombres, l.fuente AS sancion_fuente, l.id_fuente_original, coalesce(u, 'desconocida') AS url,
           'look for id ' || coalesce(l.id_fuente_original, 'None') || ' in ' || coalesce(u, 'desconocida') AS instruccion
    FROM alerts a LEFT JOIN people p USING (id_tercero) LEFT JOIN listed l ON l.id_registro = a.id_registro LEFT JOIN urls ON s = l.fuente"""


@query(_LINEAGE)
def alert_lineage(spark, sf_dir):
    return monitoring.lineage(_alerts(spark, sf_dir), entries(spark, sf_dir), parties(spark, sf_dir)).drop("timestamp")


@query(f"""WITH v AS ({_LINEAGE}) SELECT 'a' AS run_id, * FROM v UNION ALL SELECT 'b', * FROM v WHERE tipo_match = 'EXACTO_DOCUMENTO'""")
def lineage_view(spark, sf_dir):
    """Two stored runs, the second with the first's document alerts alone; each refresh joins the run that is new, and screens none."""
    history, list_, people = monitoring.AlertHistory(spark, _landing(spark, "history")), entries(spark, sf_dir), parties(spark, sf_dir)
    first = history.store(_alerts(spark, sf_dir), "a")
    joined = history.refresh(list_, people)
    history.store(first.where("tipo_match = 'EXACTO_DOCUMENTO'"), "b")
    joined += history.refresh(list_, people)
    assert joined == ["a", "b"] and history.refresh(list_, people) == []
    return history.read().drop("timestamp")


# Change capture: the state is the orders, the batch the customers' and the orders' next version


def _versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderkey") % 7 == 0, "ELIMINADO").otherwise("NUEVO")
    state = o.where("o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").cast("string").alias("id_registro"), F.col("o_orderpriority").alias("fuente"), F.lit("T").alias("tipo_sujeto"), F.col("o_orderstatus").alias("nombres"),
        F.md5(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("hash_contenido"), (F.col("o_orderkey") % 7 != 0).alias("activo"), status.alias("estado_carga"))
    price = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    batch = o.where("o_orderkey % 11 <> 0 AND o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").cast("string").alias("id_registro"), F.col("o_orderpriority").alias("fuente"), F.lit("B").alias("tipo_sujeto"), F.lit("new").alias("nombres"),
        F.md5(price.cast("decimal(18,2)").cast("string")).alias("hash_contenido"), F.lit(True).alias("activo"), F.lit(1).alias("seq"))
    return batch, state


_VERSIONS = """
    state AS (SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS fuente, 'T' AS tipo_sujeto, o_orderstatus AS nombres, md5(o_totalprice::DECIMAL(18,2)::VARCHAR) AS h, o_orderkey % 7 <> 0 AS activo,
                     CASE WHEN o_orderkey % 7 = 0 THEN 'ELIMINADO' ELSE 'NUEVO' END AS e FROM orders WHERE o_orderkey % 5 <> 0),
    batch AS (SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS fuente, 'B' AS tipo_sujeto, 'new' AS nombres, md5((CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END)::DECIMAL(18,2)::VARCHAR) AS h,
                     true AS activo FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderpriority <> '1-URGENT')"""


_UPSERT = f"""WITH {_VERSIONS}, j AS (SELECT s.id AS s_id, b.id AS b_id, s.h IS DISTINCT FROM b.h AS diff, s.*, b.* FROM state s FULL JOIN batch b ON s.id = b.id)
    SELECT coalesce(s_id, b_id) AS id_registro, CASE WHEN s_id IS NULL THEN s2.fuente ELSE s.fuente END AS fuente, CASE WHEN s_id IS NULL THEN s2.tipo_sujeto ELSE s.tipo_sujeto END AS tipo_sujeto,
           CASE WHEN s_id IS NULL OR (b_id IS NOT NULL AND diff) THEN s2.nombres ELSE s.nombres END AS nombres, CASE WHEN s_id IS NULL OR (b_id IS NOT NULL AND diff) THEN s2.h ELSE s.h END AS hash_contenido,
           CASE WHEN s_id IS NULL OR (b_id IS NOT NULL AND diff) THEN true WHEN b_id IS NULL AND s.e <> 'ELIMINADO' AND s.fuente IN (SELECT fuente FROM batch) THEN false ELSE s.activo END AS activo,
           CASE WHEN s_id IS NULL THEN 'NUEVO' WHEN b_id IS NOT NULL AND diff THEN 'MODIFICADO' WHEN b_id IS NULL AND s.fuente IN (SELECT fuente FROM batch) THEN 'ELIMINADO' ELSE s.e END AS estado_carga
    FROM (SELECT s_id, b_id, diff FROM j) LEFT JOIN state s ON s.id = s_id LEFT JOIN batch s2 ON s2.id = b_id"""


@query(_UPSERT)
def cdc_upsert(spark, sf_dir):
    batch, state = _versions(spark, sf_dir)
    return upsert(batch, state)


@query(_UPSERT)
def cdc_buckets(spark, sf_dir):
    """The same by a state in hash buckets: loaded, merged, and read in its new version."""
    batch, state = _versions(spark, sf_dir)
    stored = BucketState(spark, _landing(spark, "bucket-state"), 32, ", ".join(f"`{name}` {kind}" for name, kind in state.dtypes))
    stored.replace(state)
    stored.merge(batch)
    return stored.read()


@query(f"""WITH {_VERSIONS} SELECT count(*) FILTER (s.id IS NULL) AS nuevos, count(*) FILTER (s.id IS NOT NULL AND s.h <> b.h) AS modificados, count(*) FILTER (s.h = b.h) AS sin_cambio,
    (SELECT count(*) FROM state WHERE e <> 'ELIMINADO' AND fuente IN (SELECT fuente FROM batch) AND id NOT IN (SELECT id FROM batch)) AS eliminados
    FROM batch b LEFT JOIN state s ON s.id = b.id""")
def cdc_counts(spark, sf_dir):
    return change_counts(*_versions(spark, sf_dir))


@query("""WITH rows AS (SELECT l_orderkey::VARCHAR AS id, md5((l_quantity % 3)::INT::VARCHAR) AS h, ((l_linenumber::BIGINT * 1000000 + l_partkey) * 10000 + l_suppkey) * 100 + l_quantity::BIGINT AS seq, l_linenumber::VARCHAR AS nombres FROM lineitem),
    state AS (SELECT o_orderkey::VARCHAR AS id, md5((o_orderkey % 3)::VARCHAR) AS h FROM orders WHERE o_orderkey % 2 = 0),
    steps AS (SELECT r.*, s.id IS NOT NULL AS stored, lag(r.h) OVER w AS p, row_number() OVER w AS k, s.h AS sh FROM rows r LEFT JOIN state s USING (id) WINDOW w AS (PARTITION BY r.id ORDER BY r.seq)),
    marked AS (SELECT *, CASE WHEN k = 1 AND NOT stored THEN 'n' WHEN h = CASE WHEN k = 1 THEN sh ELSE p END THEN 's' ELSE 'm' END AS c FROM steps)
    SELECT coalesce(m.id, s.id) AS id_registro, coalesce(arg_max(m.h, seq) FILTER (c <> 's'), any_value(s.h)) AS hash_contenido, coalesce(arg_max(nombres, seq) FILTER (c <> 's'), 'old') AS nombres,
           count(*) FILTER (c = 'n') AS nuevos, count(*) FILTER (c = 'm') AS modificados, count(*) FILTER (c = 's') AS sin_cambio, count(*) FILTER (m.id IS NULL) AS eliminados,
           CASE WHEN bool_or(m.id IS NULL) THEN 'ELIMINADO' WHEN bool_or(c = 'm') THEN 'MODIFICADO' WHEN bool_or(c = 'n') THEN 'NUEVO' ELSE 'NUEVO' END AS estado_carga
    FROM marked m FULL JOIN state s ON s.id = m.id GROUP BY ALL""")
def cdc_repeated_ids(spark, sf_dir):
    """A batch of line items, several to an id, each against the one before; the state is every other order."""
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    fixed = [F.lit("S").alias("fuente"), F.lit(True).alias("activo")]
    seq = ((F.col("l_linenumber").cast("long") * 1_000_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("long")
    batch = l.select(F.col("l_orderkey").cast("string").alias("id_registro"), F.md5((F.col("l_quantity") % 3).cast("int").cast("string")).alias("hash_contenido"), seq.alias("seq"), F.col("l_linenumber").cast("string").alias("nombres"), *fixed)
    state = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("id_registro"), F.md5((F.col("o_orderkey") % 3).cast("string")).alias("hash_contenido"), F.lit("old").alias("nombres"), *fixed, F.lit("NUEVO").alias("estado_carga"))
    return merge(batch, state).select("id_registro", "hash_contenido", "nombres", *COUNTS, "estado_carga")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def replace_insert(spark, sf_dir):
    return keep_last(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


# Quality


@query("""WITH r AS (SELECT doc_id, nullif(source, 'src3') AS fuente, nullif(lang, 'de') AS nombres, md5(coalesce(text, '')) AS h, lang, source, DATE '2024-01-01' + (n_chars % 400)::INT AS f FROM documents),
    v AS (SELECT 'fuente_no_nula' AS rule, count(*) FILTER (fuente IS NULL) AS n FROM r
    UNION ALL SELECT 'fuente_con_registros', (SELECT count(*) FROM (VALUES ('src0'), ('src1'), ('src3'), ('nowhere')) AS e(s) WHERE s NOT IN (SELECT fuente FROM r WHERE fuente IS NOT NULL))
    UNION ALL SELECT 'aliases_como_lista', 0 UNION ALL SELECT 'fecha_sancion_no_futura', count(*) FILTER (f > DATE '2024-12-31') FROM r
    UNION ALL SELECT 'hash_unico_por_fuente', count(*) FROM (SELECT h, lag(h) OVER (PARTITION BY fuente, lang ORDER BY doc_id) AS p FROM r) WHERE p IS NOT NULL AND p <> h
    UNION ALL SELECT 'alerta_referencias_validas', 0 UNION ALL SELECT 'nombres_no_vacios', count(*) FILTER (nombres IS NULL) FROM r UNION ALL SELECT 'activo_es_booleano', 0)
    SELECT rule, n = 0 AS passed, n AS error_count, CASE WHEN rule IN ('fuente_no_nula', 'fuente_con_registros') THEN n ELSE least(n, 20) END AS capped_count FROM v""")
def quality_report(spark, sf_dir):
    x = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id_registro"), F.nullif("source", F.lit("src3")).alias("fuente"), F.array().cast("array<string>").alias("aliases"), F.expr("date_add(DATE '2024-01-01', int(n_chars % 400))").alias("fecha_sancion"),
        F.md5(F.coalesce("text", F.lit(""))).alias("hash_contenido"), F.col("lang").alias("id_fuente_original"), F.nullif("lang", F.lit("de")).alias("nombres"), F.lit(None).cast("string").alias("apellidos"),
        F.lit(True).alias("activo"), F.col("doc_id").alias("seq"))
    context = {"expected_sources": ["src0", "src1", "src3", "nowhere"], "today": "2024-12-31"}
    return quality.report(x, context).select("rule", "passed", "error_count", "capped_count")


@query("""WITH a AS (SELECT 'P' || user_id AS t, 'R' || (event_id % 700) AS r FROM events)
    SELECT 'alerta_referencias_validas' AS rule, count(*) FILTER (t NOT IN (SELECT 'P' || c_custkey FROM customer)) + count(*) FILTER (r NOT IN (SELECT 'R' || s_suppkey FROM supplier)) AS error_count FROM a""")
def alert_references(spark, sf_dir):
    """Alerts made of the events, against customers as third parties and suppliers as records."""
    alerts = table(spark, sf_dir, "events").select(F.concat(F.lit("P"), "user_id").alias("id_tercero"), F.concat(F.lit("R"), F.col("event_id") % 700).alias("id_registro"))
    known = {"alerts": alerts, "parties": table(spark, sf_dir, "customer").select(F.concat(F.lit("P"), "c_custkey").alias("id_tercero")), "sanctions": table(spark, sf_dir, "supplier").select(F.concat(F.lit("R"), "s_suppkey").alias("id_registro"))}
    return quality.report(known["sanctions"], known, [quality.ALERT_RULE]).select("rule", "error_count")


@query("""SELECT 'aliases_como_lista' AS rule, count(*) FILTER (c_custkey % 3 = 1) AS error_count FROM customer UNION ALL SELECT 'activo_es_booleano', count(*) FILTER (c_nationkey % 4 = 1) FROM customer""")
def raw_record_rules(spark, sf_dir):
    """The rules on types, over records that are still texts."""
    x = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id_registro"), F.when(F.col("c_custkey") % 3 == 0, '["A", "B"]').when(F.col("c_custkey") % 3 == 1, "A, B").alias("aliases"),
        F.when(F.col("c_nationkey") % 4 == 1, "yes").when(F.col("c_nationkey") % 4 == 2, "1").otherwise("false").alias("activo"))
    return quality.report(x, {}, [r for r in quality.RULES if r.name in ("aliases_como_lista", "activo_es_booleano")]).select("rule", "error_count")


@query("SELECT source AS fuente, count(*) AS n FROM documents GROUP BY ALL")
def records_per_source(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("source").alias("fuente")).agg(F.count(F.lit(1)).alias("n"))


# Monitoring: a metric for each event type, every event a sample


def _metrics(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("key"), F.col("value").cast("string").alias("value"), F.create_map().cast("map<string,string>").alias("tags"), (F.col("ts").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, 0, event_id * 0.000001)")).alias("timestamp"))


@query("SELECT event_type AS key, round(arg_max(value, ts + to_microseconds(event_id)), 6) AS value FROM events GROUP BY ALL")
def latest_metrics(spark, sf_dir):
    return monitoring.latest(_metrics(spark, sf_dir)).select("key", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("""SELECT event_type AS key, strftime(ts + to_microseconds(event_id), '%Y-%m-%d %H:%M:%S.%f') AS at, round(value, 6) AS value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts + to_microseconds(event_id) DESC) <= 5""")
def metric_history(spark, sf_dir):
    latest = Window.partitionBy("key").orderBy(F.desc("timestamp"))
    m = _metrics(spark, sf_dir).withColumn("place", F.row_number().over(latest)).where("place <= 5")
    return m.select("key", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), F.round(F.col("value").cast("double"), 6).alias("value"))


# Alert rules over the history of the events: daily counts are the match rates, the newest count of each type that of a
# source, the last day's span in seconds the duration, its mean value a hundredth of the score.

_MEASURED = """
    d AS (SELECT ts::DATE AS day, count(*)::DOUBLE AS v FROM events GROUP BY ALL),
    b AS (SELECT day, v, avg(v) OVER (ORDER BY day ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS base, row_number() OVER (ORDER BY day DESC) AS k FROM d),
    s AS (SELECT event_type, count(*) FILTER (ts::DATE = (SELECT max(day) FROM d) AND value > 400) AS n FROM events GROUP BY ALL),
    l AS (SELECT max(ts)::DATE AS day, epoch(max(ts) - min(ts)) AS seconds, avg(value) / 100 AS score FROM events WHERE ts::DATE = (SELECT max(day) FROM d))"""


def _history(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    tags, last = F.create_map().cast("map<string,string>").alias("tags"), F.max("day").over(Window.partitionBy())
    row = lambda df, key, value, at: df.select(key.alias("key"), value.cast("string").alias("value"), tags, at.cast("timestamp").alias("timestamp"))
    daily = e.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    newest = F.broadcast(e.agg(F.max("day").alias("last")))  # one row
    x = e.join(newest, F.lit(True)).withColumn("now", F.col("day") == F.col("last"))
    types = x.groupBy("event_type").agg(F.count_if(F.col("now") & (F.col("value") > 400)).alias("n"), F.max("last").alias("last"))
    day = x.where("now").agg(F.max("last").alias("last"), (F.max("ts").cast("timestamp").cast("double") - F.min("ts").cast("timestamp").cast("double")).alias("seconds"), (F.avg("value") / 100).alias("score"))
    single = [("pipeline_duration_seconds", F.col("seconds")), ("avg_match_score", F.col("score")), ("last_successful_run_timestamp", F.col("last").cast("timestamp"))]
    out = row(daily, F.lit("match_rate"), F.col("n").cast("double"), F.col("day")).unionByName(row(types, F.concat(F.lit("records_per_source/"), "event_type"), F.col("n"), F.col("last")))
    for key, value in single:
        out = out.unionByName(row(day, F.lit(key), value, F.col("last")))
    return out


@query(f"""WITH {_MEASURED}
    SELECT 'TASA_MATCHES_ANOMALA' AS rule, 'CRITICAL' AS severity, 'chat:compliance' AS channel, round(v, 6) AS value FROM b WHERE k = 1 AND base > 0 AND (v - base) / base > -0.9
    UNION ALL SELECT 'FUENTE_NO_ACTUALIZADA', 'HIGH', 'email:data-owners', floor(epoch(TIMESTAMP '2024-06-01 12:00:00' - day) / 86400) FROM l WHERE epoch(TIMESTAMP '2024-06-01 12:00:00' - day) / 86400 >= 4
    UNION ALL SELECT 'FUENTE_VACIA', 'CRITICAL', 'pager:ingestion', count(*)::DOUBLE FROM s WHERE n = 0 HAVING count(*) > 0
    UNION ALL SELECT 'LATENCIA_ALTA', 'MEDIUM', 'chat:operations', round(seconds, 6) FROM l WHERE seconds > 600
    UNION ALL SELECT 'SCORE_PROMEDIO_BAJO', 'LOW', 'email:model-owners', round(score, 6) FROM l WHERE score < 0.85""")
def fired_alerts(spark, sf_dir):
    rules = [monitoring.stale, lambda m, now: monitoring.rate_jump(m, now, most=-0.9), monitoring.empty_source, monitoring.slow, monitoring.low_score]
    return monitoring.evaluate_alerts(_history(spark, sf_dir), RUN_TS, rules).select("rule", "severity", "channel", F.round("value", 6).alias("value"))


@query(f"""WITH {_MEASURED} SELECT 'TASA_MATCHES_ANOMALA' AS rule, round(v, 6) AS value FROM b WHERE k = 1 AND base > 0 AND (v - base) / base > 0.5
    UNION ALL SELECT 'FUENTE_VACIA', count(*)::DOUBLE FROM s WHERE n = 0 HAVING count(*) > 0""")
def fired_alerts_by_default(spark, sf_dir):
    """The two critical rules with their own thresholds."""
    return monitoring.evaluate_alerts(_history(spark, sf_dir), RUN_TS, [monitoring.rate_jump, monitoring.empty_source]).select("rule", F.round("value", 6).alias("value"))


@query(f"""WITH {ALERTS} SELECT 'total_alerts' AS key, count(*)::DOUBLE AS value FROM alerts UNION ALL SELECT 'match_rate', round(count(*) / (SELECT count(*) FROM documents), 6) FROM alerts
    UNION ALL SELECT 'avg_match_score', round(avg(score_similitud), 6) FROM alerts""")
def match_rates(spark, sf_dir):
    return monitoring.matching_metrics(_alerts(spark, sf_dir), parties(spark, sf_dir), RUN_TS).select("key", F.round(F.col("value").cast("double"), 6).alias("value"))


@query(f"""WITH {PEOPLE} SELECT count(DISTINCT regexp_replace(upper(numero_documento), '[\\s\\-.]', '', 'g')) AS documents, count(DISTINCT nullif(upper(substr(nombres, 1, 1)), '')) AS initials,
    (SELECT count(DISTINCT substr({_match('a')}, 1, 5)) FROM (SELECT unnest(aliases) AS a FROM listed)) AS alias_beginnings FROM listed""")
def index_cardinalities(spark, sf_dir):
    return index_sizes(entries(spark, sf_dir), SETTINGS)


# Sources: feeds are written from the tables, and read back


@query("""SELECT s_suppkey::VARCHAR AS id_fuente_original, CASE WHEN s_nationkey % 2 = 0 THEN 'PERSONA_NATURAL' ELSE 'PERSONA_JURIDICA' END AS tipo_sujeto, s_name AS nombres,
    CASE WHEN s_nationkey % 2 = 0 THEN 'N' || s_nationkey END AS apellidos, upper('aka ' || s_name) AS alias, 'D' || s_suppkey AS numero_documento, 'P1; P' || s_nationkey AS tipo_sancion FROM supplier""")
def read_sdn_feed(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    name = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("<sdnType>Individual</sdnType><firstName>"), "s_name", F.lit("</firstName><lastName>N"), "s_nationkey", F.lit("</lastName>"))).otherwise(
        F.concat(F.lit("<sdnType>Entity</sdnType><lastName>"), "s_name", F.lit("</lastName>")))
    xml = F.concat(
        F.lit("<sdnEntry><uid>"), "s_suppkey", F.lit("</uid>"), name, F.lit("<akaList><aka><firstName>aka</firstName><lastName>"), "s_name",
        F.lit("</lastName></aka></akaList><idList><id><idType>Tax</idType><idNumber>X</idNumber></id><id><idType>Passport</idType><idNumber>D"), "s_suppkey",
        F.lit("</idNumber></id></idList><programList><program>P1</program><program>P"), "s_nationkey", F.lit("</program></programList></sdnEntry>"))
    path = _landing(spark, "sdn")
    files = s.select(F.floor(F.col("s_suppkey") / 1000).alias("file"), xml.alias("x")).groupBy("file").agg(F.array_join(F.collect_list("x"), "").alias("x"))
    files.select(F.concat(F.lit("<sdnList>"), "x", F.lit("</sdnList>")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_sdn(spark, path).select("id_fuente_original", "tipo_sujeto", "nombres", "apellidos", F.get("aliases", 0).alias("alias"), "numero_documento", "tipo_sancion")


def _canonical_sql(source: str, original: str, kind: str, names: str, surnames: str, aliases: str, country: str, document: str, sanction: str, since: str, active: str = "true", until: str = "NULL", table: str = "supplier") -> str:
    """Canonical records of texts that need no normalising; null texts are written NULL."""
    q = lambda c: f"coalesce('\"' || {c} || '\"', 'null')"
    fields = {"fecha_nacimiento": "NULL", "fecha_sancion": since, "fuente": f"'{source}'", "apellidos": surnames, "nombres": names, "numero_documento": document, "tipo_sancion": sanction, "tipo_sujeto": kind}
    text = " || ', ' || ".join(f"'\"{f}\": ' || {q(c)}" for f, c in sorted(fields.items()))
    return f"""SELECT left(sha256('{source}|' || {original} || '|' || coalesce({names}, 'None')), 16) AS id_registro, '{source}' AS fuente, {kind} AS tipo_sujeto, {names} AS nombres, {surnames} AS apellidos, {aliases} AS aliases,
        {country} AS pais, {document} AS numero_documento, {sanction} AS tipo_sancion, ({since})::DATE AS fecha_sancion, ({until})::DATE AS fecha_vencimiento, {active} AS activo, sha256('{{' || {text} || '}}') AS hash_contenido, {original} AS id_fuente_original FROM {table}"""


def _shown(records: DataFrame) -> DataFrame:
    return canonical(records, RUN_TS).select(
        "id_registro", "fuente", "tipo_sujeto", "nombres", "apellidos", F.array_join("aliases", "; ").alias("aliases"), F.array_join("nacionalidad", ",").alias("pais"), "numero_documento", "tipo_sancion", "fecha_sancion", "fecha_vencimiento",
        "activo", "hash_contenido", "id_fuente_original")


def _tag(name: str, *inner) -> Column:
    return F.concat(F.lit(f"<{name}>"), *[F.lit(x) if isinstance(x, str) else x.cast("string") for x in inner], F.lit(f"</{name}>"))


_even = "s_nationkey % 2 = 0"


@query(_canonical_sql(
    "UN", "'U' || s_suppkey", f"CASE WHEN {_even} THEN 'PERSONA_NATURAL' ELSE 'PERSONA_JURIDICA' END", f"CASE WHEN {_even} THEN 'ANA' ELSE 'FIRM ' || s_suppkey END", f"CASE WHEN {_even} THEN 'LOPEZ N' || s_suppkey END",
    f"CASE WHEN {_even} THEN 'ANITA L' ELSE 'THE FIRM' END", f"CASE WHEN {_even} THEN 'PE' ELSE 'FR' END", f"CASE WHEN {_even} THEN 'P' || s_suppkey END", f"CASE WHEN {_even} THEN 'UN SANCTIONS' ELSE 'UN ENTITY SANCTIONS' END", "'2019-03-0' || (1 + s_nationkey % 9)"))
def read_un_feed(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    since = _tag("LISTED_ON", F.concat(F.lit("2019-03-0"), 1 + F.col("s_nationkey") % 9))
    person = _tag(
        "INDIVIDUAL", _tag("DATAID", "U", F.col("s_suppkey")), "<FIRST_NAME>Ana</FIRST_NAME><SECOND_NAME> López </SECOND_NAME>", _tag("THIRD_NAME", "n", F.col("s_suppkey")), "<AKA><FIRST_NAME>Anita</FIRST_NAME><SECOND_NAME>L</SECOND_NAME></AKA>",
        since, "<NATIONALITY><VALUE>Perú</VALUE></NATIONALITY>", _tag("INDIVIDUAL_DOCUMENT", _tag("NUMBER", "P", F.col("s_suppkey"))))
    entity = _tag("ENTITY", _tag("DATAID", "U", F.col("s_suppkey")), _tag("FIRST_NAME", "Firm ", F.col("s_suppkey")), "<AKA><FIRST_NAME>the firm</FIRST_NAME></AKA>", since, "<ENTITY_ADDRESS><COUNTRY>France</COUNTRY></ENTITY_ADDRESS>")
    path = _landing(spark, "un")
    one = s.select(F.floor(F.col("s_suppkey") / 1000).alias("file"), F.when(F.expr(_even), person).otherwise(entity).alias("x")).groupBy("file").agg(F.array_join(F.collect_list("x"), "").alias("x"))
    one.select(_tag("CONSOLIDATED_LIST", F.col("x")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return _shown(read_un(spark, path))


@query("""SELECT CASE WHEN s_suppkey % 7 = 3 THEN 'malformed <INDIVIDUAL>' ELSE 'UN' END AS kind, CASE WHEN s_suppkey % 7 <> 3 THEN 'U' || s_suppkey END AS id_fuente_original, CASE WHEN s_suppkey % 7 <> 3 THEN 'ANA' END AS nombres FROM supplier
    UNION ALL SELECT CASE WHEN s_suppkey % 5 = 2 THEN 'malformed hit' ELSE 'FCPA' END, CASE WHEN s_suppkey % 5 <> 2 THEN 'H' || s_suppkey END, CASE WHEN s_suppkey % 5 <> 2 THEN 'FIRM LLC' END FROM supplier
    UNION ALL SELECT 'malformed page', NULL, NULL""")
def quarantined_entries(spark, sf_dir):
    """Entries that can't be parsed stand between others: the others are read, these are set aside with the reason."""
    s, key, rejects = table(spark, sf_dir, "supplier"), F.col("s_suppkey"), []
    broken = _tag("INDIVIDUAL", _tag("DATAID", "U", key), "<FIRST_NAME>Ana</SECOND_NAME>")
    person = F.when(key % 7 == 3, broken).otherwise(_tag("INDIVIDUAL", _tag("DATAID", "U", key), "<FIRST_NAME>Ana</FIRST_NAME>"))
    path = _landing(spark, "un-broken")
    one = s.select(F.floor(key / 1000).alias("file"), person.alias("x")).groupBy("file").agg(F.array_join(F.collect_list("x"), "\n").alias("x"))
    one.select(_tag("CONSOLIDATED_LIST", F.col("x")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    un = canonical(read_un(spark, path, rejects), RUN_TS)
    hit = F.when(key % 5 == 2, F.lit('["no hit"]')).otherwise(F.to_json(F.struct(F.struct(F.lit("Firm LLC").alias("name"), F.concat(F.lit("H"), key.cast("string")).alias("file_num")).alias("_source"))))
    pages = s.groupBy(F.floor(key / 100)).agg(F.array_join(F.collect_list(hit), ",").alias("hits")).select(F.concat(F.lit('{"hits": {"total": 1, "hits": ['), "hits", F.lit("]}}")).alias("value"))
    path = _landing(spark, "hits-broken")
    pages.unionByName(spark.createDataFrame([('{"hits": {"hits": [{',)], "value string")).write.text(path)
    hits = canonical(read_hits(spark, path, multi_line=False, rejects=rejects), RUN_TS)
    read = un.unionByName(hits).select(F.col("fuente").alias("kind"), "id_fuente_original", "nombres")
    aside = reduce(DataFrame.unionByName, rejects).select(F.col("reason").alias("kind"), F.lit(None).cast("string").alias("id_fuente_original"), F.lit(None).cast("string").alias("nombres"))
    return read.unionByName(aside)


_eu_sql = _canonical_sql(
    "EU", "'E' || s_suppkey", f"CASE WHEN {_even} THEN 'PERSONA_NATURAL' ELSE 'PERSONA_JURIDICA' END", f"CASE WHEN {_even} THEN 'JOSE' ELSE 'FIRMA ' || s_suppkey END", f"CASE WHEN {_even} THEN 'RUIZ ' || s_suppkey END",
    "'OTHER ' || s_suppkey", "'DE'", "'D' || s_suppkey", "'PROG KIND'", "'2020-02-0' || (1 + s_nationkey % 9)")


def _eu_feed(spark, sf_dir, tag: str) -> str:
    s = table(spark, sf_dir, "supplier")
    text = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    key = F.col("s_suppkey")
    name = F.when(F.expr(_even), text("José Ruiz ", key)).otherwise(text("Firma ", key))
    x = text(
        f'<{tag} logicalId="E', key, '"><subjectType code="', F.when(F.expr(_even), "person").otherwise("enterprise"), '"/><nameAlias wholeName="other ', key, '" strong="false"/><nameAlias wholeName="', name, '" strong="true"/>',
        '<citizenship countryDescription="Germany"/><identification number="X" identificationTypeCode="other"/><identification number="D', key, '" identificationTypeCode="passport"/><regulation programme="PROG" entryIntoForceDate="2020-02-0',
        1 + F.col("s_nationkey") % 9, f'"><regulationType code="KIND"/></regulation></{tag}>')
    path = _landing(spark, f"eu-{tag}")
    one = s.select(F.floor(F.col("s_suppkey") / 1000).alias("file"), x.alias("x")).groupBy("file").agg(F.array_join(F.collect_list("x"), "").alias("x"))
    one.select(_tag("export", F.col("x")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query(_eu_sql)
def read_eu_feed(spark, sf_dir):
    return _shown(read_eu(spark, _eu_feed(spark, sf_dir, "sanctionEntity")))


@query(_eu_sql)
def read_eu_feed_by_other_tag(spark, sf_dir):
    return _shown(read_eu(spark, _eu_feed(spark, sf_dir, "entity")))


@query(_canonical_sql(
    "PACO_DISC", "'PACO_DISC_' || row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) || '_C' || c_custkey", "'PERSONA_NATURAL'", "'N' || c_custkey", "'A' || c_nationkey", "''", "'CO'", "'C' || c_custkey", "'FALTA'",
    "'2021-05-06'", "c_nationkey % 2 = 0", "'2031-05-06'", "customer"))
def read_zipped_files(spark, sf_dir):
    """Archives of one delimited file each, five hundred customers to an archive."""
    import io
    import zipfile

    def archive(rows):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            lines = [f"N{r.c_custkey}|A{r.c_nationkey}|C{r.c_custkey}|Falta|06/05/2021|2031-05-06|{'Vigente' if r.c_nationkey % 2 == 0 else 'No'}" for r in rows.sort_values("c_custkey").itertuples()]
            z.writestr("readme.md", "nothing")
            z.writestr("datos.csv", "\n".join(["PRIMER_NOMBRE|PRIMER_APELLIDO|NRO_DOC|FALTA|FECHA_INICIO|FECHA_FIN|ESTADO", *lines]))
        return pd.DataFrame({"path": [str(rows["g"].iat[0])], "content": [out.getvalue()]})

    ship(spark)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.floor(F.col("c_custkey") / 500).alias("g"))
    files = c.groupBy("g").applyInPandas(archive, "path string, content binary")
    return _shown(delimited(files, "PACO_DISC", zipped=True))


@query(f"""WITH known(k, v) AS (VALUES {_known}), begins(k, v) AS (VALUES {_begins}),
    t AS (SELECT o_orderkey, i, [{', '.join("'" + t + "'" for t in COUNTRY_TEXTS)}][1 + (o_orderkey * (i + 1) + i) % {len(COUNTRY_TEXTS)}] AS x FROM orders, range(3) AS r(i)),
    n AS (SELECT o_orderkey, i, upper(nullif(trim(x), '')) AS u, {_normal("nullif(trim(x), '')")} AS n FROM t),
    c AS (SELECT o_orderkey, i, CASE WHEN regexp_full_match(u, '[A-Z]{{2}}') THEN u WHEN known.k IS NOT NULL THEN known.v WHEN begins.k IS NOT NULL THEN begins.v WHEN len(u) >= 2 THEN left(u, 2) END AS code
          FROM n LEFT JOIN known ON known.k = n.n LEFT JOIN begins ON begins.k = left(n.n, 4))
    SELECT o_orderkey, coalesce(string_agg(code, ',' ORDER BY i), '') AS codes FROM c GROUP BY o_orderkey""")
def normalize_country_lists(spark, sf_dir):
    texts = F.array(*[F.lit(t) for t in COUNTRY_TEXTS])
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.array(*[F.get(texts, ((F.col("o_orderkey") * (i + 1) + i) % len(COUNTRY_TEXTS)).cast("int")) for i in range(3)]).alias("names"))
    return x.select("o_orderkey", F.array_join(normalize_countries(F.col("names")), ",").alias("codes"))


@query("""SELECT conv_id || '-' || turn AS id_fuente_original, CASE WHEN role = 'user' THEN 'PERSONA_NATURAL' ELSE 'PERSONA_JURIDICA' END AS tipo_sujeto, CASE WHEN role = 'user' THEN role ELSE role || ' LLC' END AS nombres,
    CASE WHEN role = 'user' THEN 'Doe' END AS apellidos, 'FCPA ' || role AS tipo_sancion FROM conversations""")
def read_hits_feed(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    name = F.when(F.col("role") == "user", F.concat("role", F.lit(" Doe"))).otherwise(F.concat("role", F.lit(" LLC")))
    hit = F.struct(F.lit("x").alias("_id"), F.struct(F.array(name).alias("display_names"), F.concat_ws("-", "conv_id", "turn").alias("file_num"), F.col("role").alias("form_type")).alias("_source"))
    pages = c.groupBy(F.col("conv_id")).agg(F.collect_list(hit).alias("hits")).select(F.to_json(F.struct(F.struct(F.struct(F.size("hits").alias("value")).alias("total"), "hits").alias("hits"))).alias("value"))
    path = _landing(spark, "hits")
    pages.write.text(path)
    return read_hits(spark, path, multi_line=False).select("id_fuente_original", "tipo_sujeto", "nombres", "apellidos", "tipo_sancion")


_DEBARRED = """SELECT 'Firm ' || url AS nombres, CASE WHEN page_id % 2 = 0 THEN 'Peru' ELSE 'Chile' END AS country, 'WB_1_' || substr('Firm ' || url, 1, 30) AS id_fuente_original,
    CASE WHEN page_id % 3 = 0 THEN NULL ELSE '2023-01-31' END AS fecha_vencimiento, page_id % 3 = 0 AS activo FROM pages QUALIFY row_number() OVER (PARTITION BY upper('Firm ' || url) ORDER BY page_id) = 1"""


def _debarred_html() -> Column:
    cell = lambda c: F.concat(F.lit("<td> "), c, F.lit(" </td>"))
    return F.concat(
        F.lit("<html><table><tr><th>Firm Name</th><th>Country</th><th>From</th><th>To</th><th>Grounds</th></tr><tr>"), cell(F.concat(F.lit("Firm "), "url")),
        cell(F.when(F.col("page_id") % 2 == 0, "Peru").otherwise("Chile")), cell(F.lit("2020-01-31")), cell(F.when(F.col("page_id") % 3 == 0, "Indefinite").otherwise("2023-01-31")), cell(F.lit("Fraud")), F.lit("</tr></table></html>"))


def _debarred_shown(pages: DataFrame) -> DataFrame:
    return debarred(pages, "2024-06-01").select("nombres", F.get("nacionalidad", 0).alias("country"), "id_fuente_original", "fecha_vencimiento", "activo")


@query(_DEBARRED)
def read_debarred_pages(spark, sf_dir):
    return _debarred_shown(table(spark, sf_dir, "pages").select(F.lpad(F.col("page_id").cast("string"), 12, "0").alias("path"), _debarred_html().cast("binary").alias("content")))


@query(_DEBARRED)
def read_landed_pages(spark, sf_dir):
    """The same by the data source: the pages are landed, a file each, and read by several tasks."""
    register_pages(spark)
    path = _landing(spark, "pages")
    named = table(spark, sf_dir, "pages").select(F.concat(F.lpad(F.col("page_id").cast("string"), 12, "0"), F.lit(".html")).alias("name"), _debarred_html().cast("binary").alias("content"))

    def land(batches):
        import os

        import pyarrow as pa

        folder = path.removeprefix("file://").removeprefix("file:")
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist()):
                with open(f"{folder}/{name}", "wb") as f:
                    f.write(content)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(batch)], pa.int64())})

    named.mapInArrow(land, "n long").agg(F.sum("n")).collect()  # lands them
    return _debarred_shown(spark.read.format("vigil_pages").option("pattern", "*.html").option("taskBytes", 1 << 16).load(path))


@query("SELECT page_id, 1 AS row, 'Firm ' || url AS name, CASE WHEN page_id % 2 = 0 THEN 'Peru' ELSE 'Chile' END AS country, CASE WHEN page_id % 3 = 0 THEN 'Indefinite' ELSE '2023-01-31' END AS \"to\" FROM pages")
def table_function(spark, sf_dir):
    """HTML tables by the table function, in SQL."""
    register_pages(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", _debarred_html().alias("html"))
    return spark.sql("SELECT p.page_id, t.row, t.name, t.country, t.to FROM {pages} p, LATERAL html_table_rows(p.html) t", pages=pages)


@query("""SELECT 'PACO_PENAL' AS fuente, 'C' || c_custkey AS numero_documento, c_name AS nombres, c_mktsegment AS tipo_sancion, c_nationkey % 2 = 0 AS activo FROM customer""")
def read_delimited_files(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = _landing(spark, "delimited")
    c.select(
        F.col("c_name").alias("NOMBRES"), F.concat(F.lit("C"), "c_custkey").alias("NRO_CEDULA"), F.col("c_mktsegment").alias("DELITO"), F.when(F.col("c_nationkey") % 2 == 0, "Vigente").otherwise("Inactivo").alias("ESTADO"),
    ).write.option("header", True).option("sep", ";").csv(path)
    return read_delimited(spark, path + "/*.csv", "PACO_PENAL").select("fuente", "numero_documento", "nombres", "tipo_sancion", "activo")


@query("""WITH r AS (SELECT *, sum(1 + (c_custkey % 10 = 0)::INT) OVER (PARTITION BY c_custkey // 4000 ORDER BY c_custkey) AS n FROM customer)
    SELECT 'PACO_DISC_' || n || '_C' || c_custkey AS id_fuente_original, c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || 'a "b" ; c' ELSE '' END AS nombres, 'C' || c_custkey AS numero_documento, 'ACTO' AS tipo_sancion FROM r""")
def read_quoted_files(spark, sf_dir):
    """Files whose quoted fields hold line ends, quotes and delimiters, with blank rows between, parsed in chunks of 4 kB."""
    c = table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"'), "c_name", F.lit('\na ""b"" ; c"'))).otherwise(F.col("c_name"))
    line = F.concat(F.when(F.col("c_custkey") % 10 == 0, "\n").otherwise(""), name, F.lit(";C"), "c_custkey", F.lit(";Acto"))
    lines = c.select(F.floor(F.col("c_custkey") / 4000).alias("g"), "c_custkey", line.alias("value"))
    lines = lines.unionByName(lines.select("g").distinct().select("g", F.lit(-1).alias("c_custkey"), F.lit("NOMBRES;CEDULA;FALTA").alias("value")))
    path = _landing(spark, "quoted")
    lines.repartition("g").sortWithinPartitions("g", "c_custkey").select("g", "value").write.partitionBy("g").text(path)
    return read_delimited(spark, path + "/*/*.txt", "PACO_DISC", chunk=4096).select("id_fuente_original", "nombres", "numero_documento", F.upper("tipo_sancion").alias("tipo_sancion"))


@query("SELECT event_type, sum(props::JSON ->> 'k' :: BIGINT)::BIGINT AS k FROM events GROUP BY ALL".replace("props::JSON ->> 'k' :: BIGINT", "json_extract(props, '$.k')::BIGINT"))
def json_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.from_json("props", "k bigint")["k"]).alias("k"))


# Streams and the synthetic portfolio


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL")
def windowed_events(spark, sf_dir):
    return event_windows(table(spark, sf_dir, "events")).withColumn("mean_value", F.round("mean_value", 6)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


#: Events of a landed file of the change feed.
FEED_ROWS = 250_000


@query("""WITH e AS (SELECT user_id || '/' || event_type AS id, event_id AS seq, md5(floor(value / 5)::BIGINT::VARCHAR) AS h FROM events),
    l AS (SELECT *, lag(h) OVER w AS prev, row_number() OVER w AS k FROM e WINDOW w AS (PARTITION BY id ORDER BY seq)),
    c AS (SELECT *, CASE WHEN k = 1 THEN 'NUEVO' WHEN h IS NOT DISTINCT FROM prev THEN 'SIN_CAMBIO' ELSE 'MODIFICADO' END AS cambio FROM l)
    SELECT id AS id_registro, seq, h AS hash_contenido, prev AS hash_anterior, (sum((cambio <> 'SIN_CAMBIO')::INT) OVER (PARTITION BY id ORDER BY seq))::BIGINT AS version, cambio FROM c""")
def change_stream(spark, sf_dir):
    """A stateful stream over all events, landed in order, one file to a micro-batch: each against the last of its user and type."""
    e = table(spark, sf_dir, "events").select(F.concat_ws("/", "user_id", "event_type").alias("id_registro"), F.col("event_id").alias("seq"), F.md5(F.floor(F.col("value") / 5).cast("string")).alias("hash_contenido"))
    rows, last = e.agg(F.count(F.lit(1)), F.coalesce(F.max("seq"), F.lit(0))).first()
    files = max(4, -(-rows // FEED_ROWS))
    landing, out, checkpoint = (_landing(spark, f"feed-{name}") for name in ("in", "out", "checkpoint"))
    # One pass deals the rows to their files; these land one after the other, since the stream takes them by their age.
    dealt = _landing(spark, "feed-dealt")
    e.withColumn("file", F.expr(f"int(seq * {files} div {last + 1})")).repartition(files, "file").write.partitionBy("file").parquet(dealt)
    rows = spark.read.schema("id_registro string, seq long, hash_contenido string, file int").parquet(dealt)
    for k in range(files):
        rows.where(F.col("file") == k).drop("file").coalesce(1).write.parquet(f"{landing}/{k:06d}")
    write_changes(spark, landing, "id_registro string, seq long, hash_contenido string", out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT * FROM (VALUES (0, '', 9200), (1, 'EXACTO_NOMBRE', 320), (1, 'TIPOGRAFICO', 160), (1, 'NOMBRE_PARCIAL', 160), (1, 'ALIAS', 160)) AS t(planted, kind, n)")
def synthetic_portfolio(spark, sf_dir):
    """Planted rows by kind: the entries have aliases but no documents, so that kind falls back to exact names."""
    x = entries(spark, sf_dir).where(F.length("nombres") > 2).withColumn("numero_documento", F.lit(None).cast("string"))
    x = x.withColumn("tipo_sujeto", F.lit("PERSONA_NATURAL")).withColumn("fecha_nacimiento", F.lit(None).cast("date")).withColumn("nacionalidad", F.array(F.lit("CO")))
    rows, _ = portfolio(x, 10_000, 800)
    return rows.groupBy(F.col("es_match_plantado").alias("planted"), F.coalesce("tipo_match_plantado", F.lit("")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# What a run writes and reads again, and what it survives


@query(f"WITH {ALERTS} SELECT * FROM alerts")
def alerts_csv(spark, sf_dir):
    """The alerts by way of the CSV report, compressed as in a run."""
    path = _landing(spark, "alerts-csv")
    alerts = _alerts(spark, sf_dir).drop("timestamp")
    save_csv(alerts, path, "gzip")
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(alerts.schema).csv(path).select(*[F.coalesce(c, F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in alerts.dtypes])


@query(f"""WITH {PEOPLE} SELECT id_tercero, 'PERSONA_NATURAL' AS tipo_sujeto, coalesce(nombres, '') AS nombres, coalesce(apellidos, '') AS apellidos, coalesce(numero_documento, '') AS numero_documento, planted::INT AS es_match_plantado FROM people""")
def portfolio_csv(spark, sf_dir):
    """The portfolio by way of a CSV file: texts only, nulls as empty texts, the planted flag as a number."""
    path = _landing(spark, "portfolio-csv")
    save_csv(parties(spark, sf_dir), path)
    return read_parties(spark, path)


@query(f"""WITH {ALERTS} SELECT count(*) AS total_alertas, coalesce(min(score_similitud), 0) AS min_score, coalesce(max(score_similitud), 0) AS max_score, round(coalesce(avg(score_similitud), 0), 6) AS avg_score FROM alerts""")
def report_json(spark, sf_dir):
    """The scores by way of the JSON report."""
    path = _landing(spark, "report") + ".json"
    save_report(spark, score_summary(_alerts(spark, sf_dir), SETTINGS.high, SETTINGS.low).first().asDict(), path)
    x = spark.read.option("multiLine", True).schema("total_alertas long, min_score double, max_score double, avg_score double").json(path)
    return x.withColumn("avg_score", F.round("avg_score", 6))


@query(f"""WITH {_MEASURED} SELECT 'TASA_MATCHES_ANOMALA' AS rule, round(v, 6) AS value FROM b WHERE k = 1 AND base > 0 AND (v - base) / base > 0.5
    UNION ALL SELECT 'FUENTE_VACIA', count(*)::DOUBLE FROM s WHERE n = 0 HAVING count(*) > 0
    UNION ALL SELECT 'failed: fails_late', NULL UNION ALL SELECT 'failed: fails_at_once', NULL""")
def isolated_alert_rules(spark, sf_dir):
    """Rules that fail, when they are built or while they run, stand between others: those fire as ever, these are listed."""

    def fails_at_once(metrics, now):
        raise ValueError("no such metric")

    def fails_late(metrics, now):
        return metrics.where(F.raise_error(F.lit("bad value")).cast("boolean"))

    fired, failed = monitoring.evaluate_each(_history(spark, sf_dir), RUN_TS, [fails_at_once, monitoring.rate_jump, fails_late, monitoring.empty_source])
    listed = spark.createDataFrame([(f"failed: {f['rule']}", None) for f in failed], "rule string, value double")
    return fired.select("rule", F.round("value", 6).alias("value")).unionByName(listed)


def _people_feed(spark, sf_dir, keep: str, name: Column) -> str:
    """A UN list of the suppliers that keep holds for; every 29th entry is malformed."""
    key = F.col("s_suppkey")
    person = F.when(key % 29 == 5, _tag("INDIVIDUAL", _tag("DATAID", "U", key), "<FIRST_NAME>")).otherwise(_tag("INDIVIDUAL", _tag("DATAID", "U", key), _tag("FIRST_NAME", "Ana "), _tag("LISTED_ON", "2019-01-01"), _tag("JUSTIFICATION", name)))
    path = _landing(spark, "people")
    one = table(spark, sf_dir, "supplier").where(keep).select(F.floor(key / 1000).alias("file"), person.alias("x")).groupBy("file").agg(F.array_join(F.collect_list("x"), "\n").alias("x"))
    one.select(_tag("LIST", F.col("x")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("""WITH s AS (SELECT *, s_suppkey % 29 = 5 AS bad FROM supplier), a AS (SELECT * FROM s WHERE s_suppkey % 3 <> 0), b AS (SELECT * FROM s WHERE s_suppkey % 3 <> 1)
    SELECT 1 AS run, 'UN' AS fuente, count(*) FILTER (NOT bad) AS registros_total, count(*) FILTER (NOT bad) AS registros_nuevos, 0::BIGINT AS registros_modificados, 0::BIGINT AS registros_eliminados, (count(*) FILTER (bad))::INT AS errores FROM a
    UNION ALL SELECT 2, 'UN', count(*) FILTER (NOT bad), count(*) FILTER (NOT bad AND s_suppkey % 3 = 0), count(*) FILTER (NOT bad AND s_suppkey % 3 = 2 AND s_suppkey % 2 = 0),
        (SELECT count(*) FROM a WHERE NOT bad AND s_suppkey % 3 = 1), (count(*) FILTER (bad))::INT FROM b""")
def ingestion_log(spark, sf_dir):
    """Two runs over lists of the suppliers, with malformed entries, a source that can't be read and one that is unknown: the logs of the source that can."""
    state, aside = BucketState(spark, _landing(spark, "run-state"), 16), _landing(spark, "quarantine")
    logs = []
    for n, keep, name in ((1, "s_suppkey % 3 <> 0", F.lit("first")), (2, "s_suppkey % 3 <> 1", F.when(F.col("s_suppkey") % 2 == 0, "second").otherwise("first"))):
        landing = {"OFAC": _landing(spark, "nothing-there"), "UN": _people_feed(spark, sf_dir, keep, name), "NOPE": "x"}
        logs.append(ingest_all(spark, landing, state, RUN_TS, aside)[1].withColumn("run", F.lit(n)))
    return reduce(DataFrame.unionByName, logs).select("run", "fuente", "registros_total", "registros_nuevos", "registros_modificados", "registros_eliminados", "errores")


@query(f"""WITH {_VERSIONS} SELECT id AS id_registro, fuente, h AS hash_contenido FROM state WHERE e <> 'ELIMINADO'""")
def state_without_deleted(spark, sf_dir):
    """What screening reads of the stored state: records that aren't deleted."""
    _, state = _versions(spark, sf_dir)
    stored = BucketState(spark, _landing(spark, "stored-state"), 16, ", ".join(f"`{name}` {kind}" for name, kind in state.dtypes))
    stored.replace(state)
    return stored.current().select("id_registro", "fuente", "hash_contenido")
