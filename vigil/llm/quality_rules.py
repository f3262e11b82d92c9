"""Quality rules whose cutoffs are chosen with a bound on false rejection, in DataFrame functions only.

A row is measured on its own (no shuffle): word and line counts, and the words in 8-word windows that occur twice
(windows are compared by 64-bit hashes, which differ for different windows of a text but for chance below 1e-9).
Each rule is a ratio of two counts in thousandths. For each stratum and rule, the labelled rows are counted over a
fixed ladder of cutoffs, loosest first. A cutoff is valid if the exact binomial probability of as few rejected good
rows, were the true false-rejection rate `risk / rules`, is at most `delta / (strata * rules)` (Bonferroni over strata
and rules), and all looser cutoffs are valid too (fixed-sequence testing, so the ladder needs no further correction).
So with confidence 1 - delta, in every stratum all rules together reject at most a share `risk` of the good rows that
pass the base; the base is fixed, and what it rejects is outside the bound. Of the
valid cutoffs, the one that separates bad from good rows best is taken, the loosest among equals; a rule without a
valid cutoff rejects nothing in that stratum.

Defined cases: null text has no words and fails the base; a null stratum is a stratum of its own; rows of a stratum
without labels meet the base only; labels that contradict each other for an id, or are null, are left out; repeated
rows are judged alike; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked, written
from .exact_dedup import content_hash, without

# Fixed values of the base.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: rule: (numerator, denominator, cutoffs in thousandths from loosest to tightest). A row is rejected above the cutoff.
RULES: dict[str, tuple[str, str, list[int]]] = {
    "symbols": ("n_symbols", "word_chars", [500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40]),
    "dup_lines": ("n_dup_lines", "n_lines", [900, 800, 700, 600, 500, 450, 400, 350, 300]),
    "repeats": ("n_repeat_words", "n_words", [300, 280, 260, 240, 220, 200, 180, 160, 140, 120, 100]),
    "shouting": ("n_upper", "word_chars", [900, 800, 700, 600, 500, 450, 400, 350, 300, 250, 200]),
    "exclamation": ("n_exclamations", "n_words", [2000, 1500, 1000, 800, 600, 500, 400, 300, 250, 200]),
}


def _n(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of each row's whole text."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("string")
    x = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), F.col(stratum_col).isNull().alias("no_stratum"), text.alias("t"))
    x = x.withColumn("text_hash", content_hash(F.col("t")))
    x = x.withColumn("words", F.filter(F.split("t", SPACE), lambda w: w != ""))
    x = x.withColumn("n_words", F.size("words").cast("long"))
    x = x.withColumn("lines", F.filter(F.split("t", "\n"), lambda line: line.rlike(NOT_SPACE)))
    x = x.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    x = x.select(
        "doc_id", "stratum", "no_stratum", "text_hash", "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _n(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _n(F.col("t"), "!").cast("long").alias("n_exclamations"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.when(F.col("n_words") > WINDOW, F.transform(F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).alias("windows"),
    )
    # Only texts in which a window occurs twice are sorted: neighbours with equal hashes are the windows found again.
    x = x.withColumn("again", F.size(F.array_distinct("windows")) < F.size("windows"))
    x = x.withColumn("sorted", F.when(F.col("again"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    x = x.withColumn("twice", F.filter("sorted", lambda e, i: (e["h"] == F.get("sorted", i - 1)["h"]) | (e["h"] == F.get("sorted", i + 1)["h"])))
    x = x.withColumn("at", F.sort_array(F.transform("twice", lambda e: e["i"])))
    cover = F.aggregate(
        "at", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"],
    )
    x = x.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("long"))
    return x.drop("windows", "again", "sorted", "twice", "at")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _rung(rule: str) -> Column:
    """The first cutoff of the ladder that the row exceeds, as an index; the length of the ladder if none."""
    num, den, cutoffs = RULES[rule]
    out = F.lit(len(cutoffs))
    for k in range(len(cutoffs) - 1, -1, -1):
        out = F.when(1000 * F.col(num) > cutoffs[k] * F.col(den), k).otherwise(out)
    return out


def binomial_below(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), summed exactly in log space; 1 where k >= n * p, which is never significant."""
    step = F.log(F.lit(p)) - F.log(F.lit(1 - p))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("l"), F.exp(n * F.log(F.lit(1 - p))).alias("s"))

    def add(a: Column, i: Column) -> Column:
        log_term = a["l"] + F.log((n - i + 1) / i) + step
        return F.struct(log_term.alias("l"), (a["s"] + F.exp(log_term)).alias("s"))

    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>")), start, add, lambda a: a["s"]))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float, delta: float, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """One row for each stratum and rule with a valid cutoff: stratum, no_stratum, rule, rung, n_good, rejected_good, p."""
    agreed = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("good"), F.max(label_col).alias("__hi"))
    agreed = agreed.where("good = __hi").select("doc_id", "good")
    rungs = F.array(*[F.struct(F.lit(rule).alias("rule"), _rung(rule).alias("rung")) for rule in RULES])
    held = measured.where(~base_failed()).join(agreed, "doc_id").select("stratum", "no_stratum", "good", F.explode(rungs).alias("r"))
    counts = written(held.groupBy("stratum", "no_stratum", F.col("r.rule").alias("rule"), F.col("r.rung").alias("rung")).agg(
        F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("bad")
    ), "rung-counts")
    # Every rung needs a row, also those where no labelled row lies.
    ladder = counts.groupBy("stratum", "no_stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    size = F.create_map(*[x for rule, (_, _, c) in RULES.items() for x in (F.lit(rule), F.lit(len(c)))])
    ladder = ladder.withColumn("rung", F.explode(F.sequence(F.lit(0), size[F.col("rule")] - 1)))
    steps = ladder.join(counts, ["stratum", "no_stratum", "rule", "rung"], "left").fillna(0, ["good", "bad"])
    up = Window.partitionBy("stratum", "no_stratum", "rule").orderBy("rung").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("rejected_good", F.sum("good").over(up)).withColumn("rejected_bad", F.sum("bad").over(up))
    n_strata = counts.select("stratum", "no_stratum").distinct().count()
    steps = steps.withColumn("p", binomial_below(F.col("rejected_good"), F.col("n_good"), risk / len(RULES)))
    valid = (F.col("n_good") > 0) & (F.col("p") <= delta / (max(1, n_strata) * len(RULES)))
    steps = steps.withColumn("valid", F.min(valid).over(up)).where("valid and rejected_bad > 0")
    gain = F.col("rejected_bad") * F.col("n_good") - F.col("rejected_good") * F.col("n_bad")
    best = Window.partitionBy("stratum", "no_stratum", "rule").orderBy(gain.desc(), "rung")
    return steps.withColumn("__k", F.row_number().over(best)).where("__k = 1").select("stratum", "no_stratum", "rule", "rung", "n_good", "rejected_good", "p")


def judge(
    docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text",
    stratum_col: str = "lang", label_col: str = "quality",
) -> DataFrame:
    """One row for each row of docs: doc_id, the measures, base_failed, failed_rules (array) and kept."""
    measured = written(measures(docs, id_col, text_col, stratum_col), "measures")
    chosen = cutoffs(measured, labels, risk, delta, id_col, label_col)
    by_stratum = written(chosen.groupBy("stratum", "no_stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "rung"))).alias("rungs")), "cutoffs")
    x = measured.join(checked(by_stratum, 10_000), ["stratum", "no_stratum"], "left")
    failed = F.filter(F.array(*[F.when(_rung(rule) <= F.col("rungs")[rule], F.lit(rule)) for rule in RULES]), lambda r: r.isNotNull())
    x = x.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    return x.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("rungs")


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs that the rules keep; columns unchanged. Of rows with equal id and text in several strata, one verdict against is enough."""
    return without(docs, judge(docs, labels, id_col=id_col, text_col=text_col, **how).where("not kept"), id_col, text_col)
