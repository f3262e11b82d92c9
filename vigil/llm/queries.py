"""The queries of the operators over the standard tables, and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lm_scoring
from .common import fresh_path, table
from .cross_align import align
from .exact_dedup import exact_groups
from .fill_middle import fill_middle, restored
from .mixing import mix
from .nearest import nearest
from .ngram_join import ngram_join
from .packing import pack
from .quality_rules import judge
from .sharding import ShardStore, ingest
from .substring_dedup import repeated_passages
from .token_counts import token_counts
from .toxicity import toxicity


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_groups(table(spark, sf_dir, "documents"), keep="max")
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), min_words=50, identity=0.8)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own for each call: the query counts every text, whatever ran before.
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), cache=fresh_path(spark, "token-cache"), limit=512)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


#: The documents arrive in this many appends.
ARRIVALS = 16


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as the compacted store gives them back."""
    store = ShardStore(spark, fresh_path(spark, "shards"), target_bytes=128 << 20, fan=4)
    arrivals = store.append_split(table(spark, sf_dir, "documents"), ARRIVALS, by=["doc_id"])
    text = F.coalesce("text", F.lit(""))
    return ingest(store, arrivals, alone=True).read().select(
        "doc_id", "lang", "source", "n_chars", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("text_sha256"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.05, delta=0.05)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join(table(spark, sf_dir, "documents"), words=5, threshold=0.8, tolerance=1e-4)
    return out.select("doc_id", "cluster_id", "n_links", "copies")


#: Target weights of the standard tables' sources: the first source gets three parts, every other source one.
MIX_WEIGHTS = {"src0": 3.0}


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, other=1.0)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle(table(spark, sf_dir, "documents"), seed=42, fim_percent=50, spm_percent=80)
    again = F.sha2(restored(F.col("output"), F.col("form")), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), again.alias("restored_sha256"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "embeddings")
    return nearest(base, base.where("vec_id % 20 = 0"), k=20)


def op13_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = align(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_sharding": "SELECT doc_id, lang, source, n_chars, strlen(coalesce(text, '')) AS n_bytes, sha256(coalesce(text, '')) AS text_sha256 FROM documents",
}


def _op7_sql(risk: float = 0.05, delta: float = 0.05) -> str:
    from .quality_rules import RULES

    each = risk / len(RULES)
    rungs = " UNION ALL ".join(
        f"SELECT doc_id, stratum, '{rule}' AS rule, CASE {' '.join(f'WHEN 1000 * {num} > {c} * {den} THEN {k}' for k, c in enumerate(cutoffs))} ELSE {len(cutoffs)} END AS rung FROM measured WHERE NOT base_failed"
        for rule, (num, den, cutoffs) in RULES.items()
    )
    ladder = ", ".join(f"('{rule}', {k})" for rule, (_, _, cutoffs) in RULES.items() for k in range(len(cutoffs)))
    return f"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') || '/' || (lang IS NULL) AS stratum, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
        windows AS (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS win
                    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 8)),
        again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
        covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(8) AS r(j) GROUP BY doc_id),
        measured AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM (
                SELECT w.doc_id, stratum, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
                       len(t) - len(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                       len(t) - len(translate(t, '!', '')) AS n_exclamations, len(t) - len(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_upper,
                       coalesce(covered.n, 0) AS n_repeat_words
                FROM w LEFT JOIN covered USING (doc_id))),
        rungs AS ({rungs}),
        agreed AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
        held AS (SELECT stratum, rule, rung, good FROM rungs JOIN agreed USING (doc_id)),
        totals AS (SELECT stratum, rule, count(*) FILTER (good = 1) AS n_good, count(*) FILTER (good <> 1) AS n_bad FROM held GROUP BY ALL),
        steps AS (
            SELECT stratum, t.rule, l.rung, n_good, n_bad,
                   (SELECT count(*) FROM held h WHERE h.stratum = t.stratum AND h.rule = t.rule AND h.rung <= l.rung AND good = 1) AS k,
                   (SELECT count(*) FROM held h WHERE h.stratum = t.stratum AND h.rule = t.rule AND h.rung <= l.rung AND good <> 1) AS bad
            FROM totals t JOIN (VALUES {ladder}) AS l(rule, rung) ON l.rule = t.rule),
        tested AS (
            SELECT *, CASE WHEN k >= n_good * {each!r} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
                       exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({each!r}) + (n_good - i) * ln(1 - {each!r})))) END
                   <= {delta!r} / ((SELECT count(DISTINCT stratum) FROM totals) * {len(RULES)}) AND n_good > 0 AS ok FROM steps),
        valid AS (SELECT *, bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY rung) AS good_so_far FROM tested),
        chosen AS (SELECT stratum, rule, rung AS cut FROM valid WHERE good_so_far AND bad > 0
                   QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad * n_good - k * n_bad DESC, rung) = 1),
        rejected AS (SELECT DISTINCT doc_id FROM rungs JOIN chosen USING (stratum, rule) WHERE rung <= cut)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept FROM measured
    """


ORACLE["op7_quality_rules"] = _op7_sql()


# All pairs of different texts that share a shingle, counted exactly.
ORACLE["op9_ngram_jaccard_join"] = r"""
    WITH RECURSIVE t AS (SELECT coalesce(text, '') AS x, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1),
    w AS (SELECT *, regexp_extract_all(lower(x), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM t),
    s AS (SELECT first_id, copies, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM w),
    n AS (SELECT first_id, any_value(copies) AS copies, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.first_id AS a, b.first_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.first_id < b.first_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.first_id = a JOIN n y ON y.first_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
    pairs AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    reach(a, r) AS (SELECT first_id, first_id FROM t UNION SELECT pairs.b, reach.r FROM reach JOIN pairs ON pairs.a = reach.a),
    root AS (SELECT a AS first_id, min(r) AS cluster_id FROM reach GROUP BY 1),
    l AS (SELECT a AS first_id, sum(n.copies) AS links FROM pairs JOIN n ON n.first_id = pairs.b GROUP BY 1)
    SELECT doc_id, cluster_id, (coalesce(links, 0) + copies - 1)::BIGINT AS n_links, copies FROM documents JOIN t ON t.x = coalesce(text, '') JOIN root USING (first_id) LEFT JOIN l USING (first_id)
"""
# One row a slot and source that has blocks left; `hit` marks the released block of the earliest deadline.
ORACLE["op10_mix_sources"] = """
    WITH RECURSIVE n AS (
        SELECT source, coalesce('=' || source, '?') AS key, (count(*) + 15) // 16 AS blocks, CASE WHEN source = 'src0' THEN 3 ELSE 1 END AS w FROM documents GROUP BY source),
    run AS (
        SELECT -1 AS slot, source, key, blocks, w, 0 AS done, 0 AS phase_done, 0 AS phase_start, false AS hit FROM n
        UNION ALL
        SELECT slot + 1, source, key, blocks, w, done + hit::INT, CASE WHEN ended THEN 0 ELSE phase_done + hit::INT END, CASE WHEN ended THEN slot + 2 ELSE phase_start END, hit
        FROM (SELECT * EXCLUDE (hit), turn = 1 AS hit, bool_or(turn = 1 AND done + 1 = blocks) OVER () AS ended
              FROM (SELECT *, row_number() OVER (ORDER BY release <= slot + 1 - phase_start DESC, deadline, next_release, key) AS turn
                    FROM (SELECT *, phase_done * q // w AS release, ((phase_done + 1) * q + w - 1) // w AS deadline, (phase_done + 1) * q // w AS next_release
                          FROM (SELECT *, (sum(w) OVER ())::BIGINT AS q FROM run WHERE done < blocks))))),
    placed AS (SELECT source, done - 1 AS block, slot FROM run WHERE hit),
    ranked AS (
        SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT, doc_id) - 1 AS rank FROM documents)
    SELECT doc_id, source, block, slot, slot * 16 + rank % 16 AS position
    FROM ranked JOIN placed USING (source) WHERE block = rank // 16
"""


# Cuts by character: a unit ends where white space follows something else, and at the end of the text.
ORACLE["op11_fill_middle"] = r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || doc_id) AS hex FROM documents),
    h AS (SELECT *, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2, ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4,
                 string_split(regexp_replace(x, '([^\x20\x09-\x0D])([\x20\x09-\x0D])', '\1' || chr(0) || '\2', 'g'), chr(0)) AS u FROM t),
    n AS (SELECT *, CASE WHEN x = '' THEN 0 ELSE len(u) END AS n FROM h),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
                 CASE WHEN x = '' OR regexp_matches(x, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n),
    p AS (SELECT *, len(array_to_string(u[:c1], '')) AS k1, len(array_to_string(u[:c2], '')) AS k2 FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN k1 END AS prefix_chars, CASE WHEN form <> 'plain' THEN k2 - k1 END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || substr(x, 1, k1) || '<S>' || substr(x, k2 + 1) || '<M>' || substr(x, k1 + 1, k2 - k1)
                            ELSE '<S>' || substr(x, k2 + 1) || '<P>' || substr(x, 1, k1) || '<M>' || substr(x, k1 + 1, k2 - k1) END) AS output_sha256,
           sha256(x) AS restored_sha256
    FROM p
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_substring_dedup, op3_best_fit_packing, op4_token_counts, op5_lm_scoring, op6_sharding, op7_quality_rules, op8_toxicity, op9_ngram_jaccard_join, op10_mix_sources, op11_fill_middle, op12_nearest_neighbours, op13_cross_alignment)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
