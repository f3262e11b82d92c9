"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's probability is logistic in its words and their stems, a document's is the noisy-or of its sentences, and both are trained
from document labels alone. The fit reads a bounded sample of the labelled rows (max_fit, those with the smallest hash
of the id, so the driver holds the known features of at most max_fit whole texts); features enter the model if their document frequencies in the two classes differ by more than least_z standard
errors. Scoring reads every whole text once, without a shuffle, and names the worst sentence.

Defined cases: null text counts as empty, and a text without sentences scores 0; a null id is never held out; labels
that are null or contradict each other are left out; without labels of both classes every score is the share of toxic
labels among those there are (0 if none); repeated rows score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
PREFIX = (3, 10)
SCORED = "doc_id long, held_out boolean, score double, n_sentences long, n_offending long, worst_start long, worst_end long, worst_score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(word: str) -> list[str]:
    """A word's features: itself, marked as whole, and its proper prefixes, for stems that take many endings."""
    return [f"{word}$", *(word[:k] for k in range(PREFIX[0], min(len(word), PREFIX[1] + 1)))]


class Known(dict):
    """word -> the model's features of it; forgets all when it has grown to a fixed size."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= 200_000:
            self.clear()
        self[word] = own = [self.index[f] for f in features(word) if f in self.index]
        return own


def bags(text: str, known: Known) -> tuple[int, list[tuple[int, int, list[int]]]]:
    """The number of sentences that hold a word, and (start, end, features) of those that hold a known feature."""
    n, found = 0, []
    for m in SENTENCE.finditer(text):
        own = WORD.findall(m[0].lower())
        if own:
            n += 1
            if bag := {f for w in own for f in known[w]}:
                found.append((m.start(), m.end(), sorted(bag)))
    return n, found


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n: Counter[str] = Counter()
        pos: Counter[str] = Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = {f for w in set(WORD.findall(text.lower())) for f in features(w)}
            n.update(own)
            if toxic:
                pos.update(own)
        yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array([pos[f] for f in n], pa.int64()), pa.array(n.values(), pa.int64())], ["feature", "pos", "n"])


def _features(words: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(words)
        for batch in batches:
            n, own = [], []
            for text in batch.column(0).to_pylist():
                k, found = bags(text, known)
                n.append(k)
                own.append([x[2] for x in found])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int64()), pa.array(own, pa.list_(pa.list_(pa.int32())))], ["toxic", "n", "bags"])

    return run


def fit_noisy_or(toxic: np.ndarray, n: np.ndarray, docs: list[list[list[int]]], n_words: int, steps: int = 600, rate: float = 0.1, decay: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights of the words and the bias, by Adam on the likelihood of the document labels."""
    sentence_doc = np.array([d for d, own in enumerate(docs) for _ in own], dtype=np.int64)
    flat = [b for own in docs for b in own]
    row = np.repeat(np.arange(len(flat)), [len(b) for b in flat]) if flat else np.zeros(0, np.int64)
    col = np.array([w for b in flat for w in b], dtype=np.int64)
    plain = n - np.bincount(sentence_doc, minlength=len(n)) if len(flat) else n
    y = toxic.astype(float)
    w, bias = np.zeros(n_words), -6.0
    m, v = np.zeros(n_words + 1), np.zeros(n_words + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, weights=w[col], minlength=len(flat))
        soft = np.logaddexp(0, z)  # -log(1 - p) of a sentence
        base = np.logaddexp(0, bias)
        total = np.bincount(sentence_doc, weights=soft, minlength=len(n)) + plain * base
        total = np.maximum(total, 1e-9)
        # d loss / d total: -y / (e^total - 1) + (1 - y)
        pull = np.where(y > 0, -1 / np.expm1(np.minimum(total, 50)), 1.0)
        pull /= len(n)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
        per_sentence = pull[sentence_doc] * p
        grad = np.append(np.bincount(col, weights=per_sentence[row], minlength=n_words) + decay * w, per_sentence.sum() + (pull * plain).sum() * p0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _score(words: dict[str, int], weights: np.ndarray, bias: float, constant: float | None, offending: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, known = np.logaddexp(0, bias), Known(words)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for text in batch.column(2).to_pylist():
                n, found = bags(text, known)
                z = np.array([bias + weights[b].sum() for _, _, b in found])
                total = (n - len(found)) * base + (np.logaddexp(0, z).sum() if len(z) else 0.0)
                p = 1 / (1 + np.exp(-z)) if len(z) else z
                worst = int(p.argmax()) if len(p) else -1
                row = (
                    constant if constant is not None else float(-np.expm1(-total)), n, int((p >= offending).sum()),
                    found[worst][0] if len(p) else None, found[worst][1] if len(p) else None, float(p[worst]) if len(p) else None,
                )
                for to, x in zip(out, row):
                    to.append(x)
            arrays = [pa.array(x, t) for x, t in zip(out, (pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "held_out", "score", "n_sentences", "n_offending", "worst_start", "worst_end", "worst_score"])

    return run


def toxicity(
    docs: DataFrame, labels: DataFrame, max_fit: int = 20_000, max_words: int = 2_000, least_z: float = 4.0, threshold: float = 0.7, offending: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted (score >= threshold), n_sentences, n_offending
    (sentences of probability >= offending) and the worst sentence's place (characters) and probability.

    Rows with crc32(id as text) mod 3 = 1 are held out: their labels are never read.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("string")
    agreed = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).alias("toxic"), F.max(label_col).alias("__hi"))
    usable = agreed.where((F.col("toxic") == F.col("__hi")) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    few = F.broadcast(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_fit))  # bounded by max_fit
    fit = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).join(few, "doc_id").select("text", "toxic"), "toxic-fit")
    n_neg, n_pos = (fit.where(F.col("toxic") == k).count() for k in (0, 1))
    words: dict[str, int] = {}
    weights, bias, constant = np.zeros(0), -30.0, (n_pos / (n_pos + n_neg) if n_pos + n_neg else 0.0)
    if n_pos and n_neg:
        constant = None
        df = fit.select("text", "toxic").mapInArrow(_frequencies, "feature string, pos long, n long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        share = F.col("n") / (n_pos + n_neg)
        z = (F.col("pos") / n_pos - (F.col("n") - F.col("pos")) / n_neg) / F.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_neg) + 1e-12)
        top = df.where("pos >= 3").withColumn("z", z).where(F.abs("z") >= least_z).orderBy(F.desc(F.abs("z")), "feature").limit(max_words)
        words = {r["feature"]: i for i, r in enumerate(top.select("feature").collect())}  # at most max_words
        rows = fit.select("text", "toxic").mapInArrow(_features(words), "toxic int, n long, bags array<array<int>>").collect()  # at most max_fit
        weights, bias = fit_noisy_or(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [r[2] for r in rows], len(words))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text.alias("text"))
    scored = source.mapInArrow(_score(words, weights, bias, constant, offending), SCORED)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
