"""Masked pseudo-likelihood: every token is predicted from the tokens on both its sides, and a document's score is the
sum of the log-probabilities.

The network's outputs are the corpus's most frequent words, counted over all rows, and hash buckets for the others. A
word of a bucket has the bucket's probability times its own share of the bucket's tokens in the whole corpus; these
shares grow with the corpus, so they are joined: each chunk of texts meets only the words it holds. The network embeds
the `reach` tokens on either side (an embedding for each place), adds them, applies tanh and predicts in two steps, the
output's class and the output within the class, each by a softmax; it is trained in numpy by Adagrad on all positions.

Texts are dealt over shards of about SHARD tokens by a hash of id and text. Every shard trains its own copy, in the order
of those hashes, and the copies are averaged, weighted by positions, over a tree of tasks: no task and not the driver
holds more than TREE copies. So a model depends on the rows, not on how they lie in files and partitions. Scoring reads
every whole text and every position.

Defined cases: null text counts as empty; a text without words has n_tokens 0, log_prob 0 and no mean; null ids are
kept; rows repeated score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .words import chunks, word_hashes

#: Copies of the network that one task adds up, and tokens that train one copy.
TREE, SHARD = 8, 2_000_000
#: Positions of a training step, of a block that is scored at once, and whose contexts are laid out at once.
BATCH, SCORED, SLICE = 2048, 8192, 64 * 1024
#: Tokens outside the frequent words in a chunk of scored texts.
CHUNK = 2_000_000
#: Most outputs of a class.
PER_CLASS = 64
#: The bias of an output that stands for no word: it gets no probability, hence no gradient, and stays as it is.
NEVER = -1e9
SCORES = "chunk long, word long, doc_id long, n_tokens long, log_prob double, rare binary"
Net = dict[str, np.ndarray]


class Vocabulary:
    """Outputs for word hashes: the frequent words, most frequent first, and `buckets` shared ones, dealt in turn over
    classes of PER_CLASS outputs, so that classes are alike in use; `size` stands for no token. Where they don't fill
    all classes alike, `padding` (classes x outputs of a class) marks the places that stand for no word."""

    def __init__(self, frequent: list[int], buckets: int):
        by_count = np.array([h & 0xFFFFFFFFFFFFFFFF for h in frequent], dtype=np.uint64)
        self.buckets, n = buckets, len(frequent) + buckets
        self.classes = -(-n // PER_CLASS)
        self.per = -(-n // self.classes)
        self.size = self.classes * self.per
        self.padding = np.ones((self.classes, self.per), bool)
        self.padding.ravel()[self._output(np.arange(n))] = False
        order = np.argsort(by_count)
        self.hashes, self.words, self.shared = by_count[order], self._output(order), self._output(np.arange(len(frequent), n))

    def _output(self, i: np.ndarray) -> np.ndarray:
        return i % self.classes * self.per + i // self.classes

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(output, whether it is a bucket's) of each word."""
        out = self.shared[(words % np.uint64(self.buckets)).astype(np.int64)]
        if not len(self.hashes):
            return out, np.ones(len(words), bool)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        known = self.hashes[at] == words
        return np.where(known, self.words[at], out), ~known

    def ids(self, words: np.ndarray) -> np.ndarray:
        return self.find(words)[0]


def new_net(vocabulary: Vocabulary, width: int, reach: int, seed: int) -> Net:
    rng, classes, per = np.random.default_rng(seed), vocabulary.classes, vocabulary.per
    normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {
        "embed": normal(2 * reach, vocabulary.size + 1, width), "hidden": np.zeros(width, np.float32), "class": normal(width, classes), "class_bias": np.zeros(classes, np.float32),
        "out": normal(classes, width, per), "bias": np.where(vocabulary.padding, NEVER, 0).astype(np.float32),
    }


def flat(net: Net) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in sorted(net)])


def shaped(values: np.ndarray, like: Net) -> Net:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def contexts(ids: np.ndarray, counts: np.ndarray, reach: int, none: int) -> np.ndarray:
    """The ids on both sides of each position (positions x 2 * reach), `none` beyond the text's ends."""
    n = len(ids)
    text = np.repeat(np.arange(len(counts)), counts)
    out = np.full((n, 2 * reach), none, dtype=np.int64)
    for k in range(1, reach + 1):
        same = text[k:] == text[:-k]
        out[k:, k - 1][same] = ids[:-k][same]
        out[:-k, reach + k - 1][same] = ids[k:][same]
    return out


def _hidden(net: Net, context: np.ndarray) -> np.ndarray:
    h = net["embed"][0].take(context[:, 0], axis=0)
    for k in range(1, context.shape[1]):
        h += net["embed"][k].take(context[:, k], axis=0)
    h += net["hidden"]
    return np.tanh(h, out=h)


def _by_class(target: np.ndarray, per: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of positions by their targets' classes, and (class, begin, end) of each class there is."""
    of = target // per
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order], prepend=-1)).tolist()
    return order, [(int(of[order[i]]), i, j) for i, j in zip(cuts, [*cuts[1:], len(order)])]


def _log_softmax_at(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    z = weights.T @ h.T  # outputs x positions: sums over outputs run along whole rows
    z += bias[:, None]
    z -= z.max(axis=0)
    own = z[at, np.arange(len(at))].astype(np.float64)
    return own - np.log(np.exp(z, out=z).sum(axis=0).astype(np.float64))


def log_probs(net: Net, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(target | context) of each position: of its class among all, and of itself within the class."""
    out, per = np.empty(len(target), np.float64), net["bias"].shape[1]
    for i in range(0, len(target), SCORED):  # blocks that stay in the cache
        order, groups = _by_class(target[i : i + SCORED], per)
        h, t = _hidden(net, context[i : i + SCORED][order]), target[i : i + SCORED][order]
        logs = _log_softmax_at(h, net["class"], net["class_bias"], t // per)
        for c, begin, end in groups:
            logs[begin:end] += _log_softmax_at(h[begin:end], net["out"][c], net["bias"][c], t[begin:end] % per)
        out[i + order] = logs
    return out


def _error(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The loss's gradient for the scores (outputs x positions) of a softmax; n positions make up the step."""
    z = weights.T @ h.T
    z += bias[:, None]
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0) * np.float32(n)
    z[at, np.arange(len(at))] -= np.float32(1 / n)
    return z


def train(net: Net, squares: Net, context: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One pass of Adagrad over the positions, in place."""

    def step(values: np.ndarray, squared: np.ndarray, grad: np.ndarray) -> None:
        squared += grad * grad
        values -= rate * grad / np.sqrt(squared + 1e-8)

    per, (places, size, width) = net["bias"].shape[1], net["embed"].shape
    embed, embed_squares = net["embed"].reshape(-1, width), squares["embed"].reshape(-1, width)
    row_of = np.arange(places) * size
    for i in range(0, len(target), BATCH):
        order, groups = _by_class(target[i : i + BATCH], per)
        c, t = context[i : i + BATCH][order], target[i : i + BATCH][order]
        n = len(t)
        h = _hidden(net, c)
        p = _error(h, net["class"], net["class_bias"], t // per, n)
        grad_h = p.T @ net["class"].T
        step(net["class"], squares["class"], (p @ h).T)
        step(net["class_bias"], squares["class_bias"], p.sum(axis=1))
        out, bias = np.zeros_like(net["out"]), np.zeros_like(net["bias"])
        for k, begin, end in groups:
            own = h[begin:end]
            p = _error(own, net["out"][k], net["bias"][k], t[begin:end] % per, n)
            grad_h[begin:end] += p.T @ net["out"][k].T
            out[k] = (p @ own).T
            bias[k] = p.sum(axis=1)
        step(net["out"], squares["out"], out)
        step(net["bias"], squares["bias"], bias)
        grad_h *= 1 - h * h
        step(net["hidden"], squares["hidden"], grad_h.sum(axis=0))
        rows = (c + row_of).ravel()
        order = np.argsort(rows.astype(np.uint16) if places * size < 1 << 16 else rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        grad = np.add.reduceat(grad_h.take(order // places, axis=0), first, axis=0)
        rows = rows[first]
        squared = embed_squares[rows] + grad * grad
        embed_squares[rows] = squared
        embed[rows] -= rate * grad / np.sqrt(squared + 1e-8)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [word_hashes(data, offsets)[0] for _, data, offsets in chunks(batch.column(0))]
        if found:
            words, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])


def _encode(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text, mark) -> (mark, the text's outputs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch.column(0)):
                words, counts = word_hashes(data, offsets)
                ids, ends = vocabulary.ids(words).astype("<u2"), np.append(0, np.cumsum(counts))
                some = np.flatnonzero(counts)
                own = [ids[ends[i] : ends[i + 1]].tobytes() for i in some.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(some + row)), pa.array(own, pa.binary())], ["mark", "ids"])

    return run


def slices(texts: Iterator[np.ndarray], reach: int, none: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(contexts, targets) of all positions of the texts, in slices that depend on the texts alone; long texts are cut."""
    held, n = [], 0

    def laid() -> tuple[np.ndarray, np.ndarray]:
        counts = np.array([len(x) for x, _, _ in held])
        begin = np.cumsum(counts) - counts
        ids = np.concatenate([x for x, _, _ in held])
        around = contexts(ids, counts, reach, none)
        inner = np.concatenate([np.arange(b + lo, b + hi) for b, (_, lo, hi) in zip(begin, held)])
        return around[inner], ids[inner]

    for ids in texts:
        for at in range(0, len(ids), SLICE):
            from_, to = max(0, at - reach), min(len(ids), at + SLICE)
            held.append((ids[from_ : to + reach], at - from_, to - from_))
            n += to - at
            if n >= SLICE:
                yield laid()
                held, n = [], 0
    if held:
        yield laid()


def _train(net: Net, vocabulary: Vocabulary, reach: int, rate: float, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts (shard, ids) sorted by shard -> each shard's trained copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((s, np.frombuffer(x.as_buffer(), "<u2").astype(np.int64)) for batch in batches for s, x in zip(batch.column(0).to_pylist(), batch.column(1)))
        for shard, group in groupby(texts, key=lambda x: x[0]):
            own, squares = {k: v.copy() for k, v in net.items()}, {k: np.full_like(v, 1e-2) for k, v in net.items()}
            rng, trained = np.random.default_rng([seed, shard]), 0
            for around, ids in slices((x for _, x in group), reach, vocabulary.size):
                mixed = rng.permutation(len(ids))
                train(own, squares, around[mixed], ids[mixed], rate)
                trained += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([trained], pa.int64()), pa.array([(flat(own).astype(np.float64) * trained).tobytes()], pa.binary())], ["shard", "n", "total"])

    return run


def _add(copies: pd.DataFrame) -> pd.DataFrame:
    copies = copies.sort_values("shard")
    total = sum(np.frombuffer(x, np.float64) for x in copies["total"])
    return pd.DataFrame({"shard": [int(copies["shard"].iat[0]) // TREE], "n": [int(copies["n"].sum())], "total": [total.tobytes()]})


def _score(net: Net, vocabulary: Vocabulary, reach: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row of SCORES for each text, with the hashes of its words in buckets, and after each chunk one for each of its words in buckets."""

    def words_of(chunk: int, found: list[np.ndarray]) -> pa.RecordBatch:
        words = np.unique(np.concatenate([np.zeros(0, np.uint64), *found])).view(np.int64)
        n = len(words)
        columns = [pa.array(np.full(n, chunk)), pa.array(words), *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "word", "doc_id", "n_tokens", "log_prob", "rare"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, found, tokens = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            n, total, rare = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), [b""] * batch.num_rows
            for row, data, offsets in chunks(batch.column(1)):
                words, counts = word_hashes(data, offsets)
                if not len(words):
                    continue
                ids, bucketed = vocabulary.find(words)
                logs = log_probs(net, contexts(ids, counts, reach, vocabulary.size), ids)
                some = np.flatnonzero(counts)
                n[row + some] = counts[some]
                total[row + some] = np.add.reduceat(logs, (np.cumsum(counts) - counts)[some])
                own = words[bucketed]
                ends = np.append(0, np.cumsum(bucketed))[np.append(0, np.cumsum(counts))]
                for i in some.tolist():
                    rare[row + i] = own[ends[i] : ends[i + 1]].tobytes()
                found.append(np.unique(own))
                tokens += len(own)
            columns = [pa.array(np.full(batch.num_rows, chunk)), pa.nulls(batch.num_rows, pa.int64()), batch.column(0), pa.array(n), pa.array(total), pa.array(rare, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "word", "doc_id", "n_tokens", "log_prob", "rare"])
            if tokens >= CHUNK:
                yield words_of(chunk, found)
                chunk, found, tokens = chunk + 1, [], 0
        yield words_of(chunk, found)

    return run


def _add_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk, its words (with log_prob log P(word | bucket)) before its texts -> the texts' sums."""
    at, known, logs, parts = None, np.zeros(0, np.uint64), np.zeros(0), []
    for batch in batches:
        chunk, is_word = batch.column(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (is_word[1:] != is_word[:-1]))).tolist() if len(chunk) else []
        for begin, end in zip(cuts, [*cuts[1:], len(chunk)]):
            if chunk[begin] != at:
                at, known, logs, parts = chunk[begin], np.zeros(0, np.uint64), np.zeros(0), []
            own = batch.slice(begin, end - begin)
            if is_word[begin]:
                parts.append((own.column(1).to_numpy().view(np.uint64), own.column(4).to_numpy()))
                continue
            if parts:
                known, logs = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(known)
                known, logs, parts = known[order], logs[order], []
            total = own.column(4).to_numpy().copy()
            for i, rare in enumerate(own.column(5)):
                words = np.frombuffer(rare.as_buffer(), np.uint64)
                if len(words):
                    total[i] += logs[np.searchsorted(known, words)].sum()
            yield pa.RecordBatch.from_arrays([own.column(2), own.column(3), pa.array(total)], ["doc_id", "n_tokens", "log_prob"])


def fit(texts: DataFrame, frequent: int = 896, buckets: int = 128, width: int = 32, reach: int = 2, rounds: int = 1, rate: float = 0.1) -> tuple[Net, Vocabulary, DataFrame]:
    """The network, vocabulary and word counts of a table (doc_id, text) without null texts; a round trains on all positions."""
    counts = written(texts.select("text").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    top = [r[0] for r in counts.orderBy(F.desc("n"), "word").limit(frequent).collect()]  # at most `frequent`
    vocabulary = Vocabulary(top, buckets)
    net = new_net(vocabulary, width, reach, seed=1)
    shards = -(-(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // SHARD)
    mark = F.xxhash64(F.lit(31), "doc_id", "text").alias("mark")
    for k in range(rounds if shards else 0):
        encoded = texts.select("text", mark).mapInArrow(_encode(vocabulary), "mark long, ids binary").withColumn("shard", F.pmod("mark", F.lit(shards)))
        dealt = encoded.repartition(min(shards, 10_000), "shard").sortWithinPartitions("shard", "mark", "ids").select("shard", "ids")
        copies, left = written(dealt.mapInArrow(_train(net, vocabulary, reach, rate, seed=100 + k), "shard long, n long, total binary"), "lm-copies"), shards
        while left > 1:  # a tree of sums; a group holds TREE copies
            left = -(-left // TREE)
            copies = written(copies.groupBy(F.floor(F.col("shard") / TREE).alias("g")).applyInPandas(_add, "shard long, n long, total binary"), "lm-sums")
        row = copies.first()
        net = shaped(np.frombuffer(row["total"], np.float64) / row["n"], net)
    return net, vocabulary, counts


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, log_prob (sum over the tokens) and mean_log_prob."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text")
    reach = how.get("reach", 2)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    net, vocabulary, counts = fit(own, **how)
    scored = written(own.mapInArrow(_score(net, vocabulary, reach), SCORES), "lm-scores")
    # The share of each word outside the frequent ones in its bucket's tokens; hashes count as unsigned, as in Vocabulary.
    b = vocabulary.buckets
    unsigned = F.pmod(F.pmod("word", F.lit(b)) + F.when(F.col("word") < 0, F.lit((1 << 64) % b)).otherwise(F.lit(0)), F.lit(b))
    frequent = docs.sparkSession.createDataFrame([(int(h),) for h in vocabulary.hashes.view(np.int64)], "word long")  # at most `frequent`
    rare = counts.join(F.broadcast(frequent), "word", "left_anti").withColumn("bucket", unsigned)
    totals = rare.groupBy("bucket").agg(F.sum("n").alias("of"))  # at most `buckets` rows
    shares = rare.join(F.broadcast(totals), "bucket").select("word", F.log(F.col("n") / F.col("of")).alias("share"))
    words = scored.where("word IS NOT NULL").select("chunk", "word").join(shares, "word")
    words = words.select("chunk", "word", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"), F.col("share").alias("log_prob"), F.lit(None).cast("binary").alias("rare"))
    both = scored.where("word IS NULL").unionByName(words).repartition("chunk").sortWithinPartitions("chunk", F.col("word").isNull())
    out = both.mapInArrow(_add_shares, "doc_id long, n_tokens long, log_prob double")
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
