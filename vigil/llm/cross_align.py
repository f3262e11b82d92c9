"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

The token streams of a text are compared relationally: tokens are exploded with their places, a window sums their byte
lengths to ends, both streams meet on (text, end), a running count of the ends they share numbers the groups, and a
shared end links the two tokens that end there. That is DataFrame functions; Python calls the tokenizers before it and
lays the groups of a text's segments end to end after it.

It runs on distinct segments rather than on every occurrence. A single space between two visible characters is a border
for both tokenizers, whatever stands around (A splits there before it merges; no piece of B holds a space behind another
character, which is checked when its file is read), so a text's tokens, groups and links are those of its segments, laid
end to end, and a segment that occurs a million times is encoded and aligned once, and counted a million times. Texts are
dealt into blocks of bounded size; a block gets the entries of its own distinct segments, and its texts' groups are
put together there. So no row for each token of the corpus is ever shuffled.

Of two tokens that end together one is a suffix of the other, so the pairs that can be linked are at most the bytes of
both vocabularies, whatever the corpus: the table of their counts may be broadcast. So may the vocabularies' lengths.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a SentencePiece BPE file with byte fallback whose
normaliser changes nothing; both lose no byte, but B writes the character U+2581 as a space.

Defined cases: a text that is null, empty, or holds U+2581 (B's bytes would differ from it) has no tokens: zeros and
empty groups; special strings in texts are plain text; repeated rows each count; a null id is kept; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_table, kept, ship, written
from .encoding import _byte_letters, _ranks

#: B's space. Texts that hold it have no tokens, so it also serves to mark borders.
SPACE = "▁"
#: A border: a single space between visible ASCII characters, letters or digits.
BORDER = r"(?<=[!-~\p{L}\p{N}]) (?=[!-~\p{L}\p{N}])"
#: Bytes of the texts that are put together in one task, on average; a longer text makes its block larger.
BLOCK_BYTES = 16 << 20
#: Bytes of rows of one block that are packed together at most.
PACK = 8 << 20
#: Segments that are put together at once.
AT_ONCE = 200_000


@cache
def _library(path: str):
    """The library's own tokenizer, loaded only where it is needed: idle workers keep what they have loaded."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return whole


@cache
def byte_level(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """A's encoder of texts, each with a space before it, and the bytes of its ids. Special strings are plain text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError(f"{path} is no plain byte-level tokenizer")
    letters, words = _byte_letters(), {i: w for w, i in spec["model"]["vocab"].items()}
    tokens = [bytes(letters[c] for c in words.get(i, "") if c in letters) for i in range(max(words) + 1)]
    ranks = _ranks(path)

    def library(text: str) -> list[int]:
        return _library(path).encode(text, add_special_tokens=False).ids

    if ranks is None:
        return lambda texts: [library(" " + t) for t in texts], tokens
    import public_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def one(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except ValueError:  # the pattern's stack is full
            return library(text)

    return lambda texts: [one(" " + t) for t in texts], tokens


@cache
def pieces(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """B's encoder of texts, before which it puts a space, and the bytes of its ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    if any(SPACE in p.lstrip(SPACE) for p in names) or not any(model.is_byte(i) for i in range(n)):
        raise ValueError(f"{path}: pieces hold inner spaces, or there is no byte fallback")
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
    return lambda texts: model.encode(texts, num_threads=1), tokens


def _ids(encoded: list[list[int]]) -> pa.ListArray:
    ends = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(x) for x in encoded], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter((i for x in encoded for i in x), np.int32, ends[-1])))


def _encoded(segments: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, str]:
    """Segments (seg, n) with a and b, the ids of both tokenizers, and a number, num; the table's path."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [byte_level(a_path), pieces(b_path)]
        for batch in batches:
            texts = batch["seg"].to_pylist()
            want = "".join([" " + t for t in texts]).encode()
            columns = []
            for encode_all, tokens in sides:
                got = encode_all(texts)
                if b"".join([tokens[i] for x in got for i in x]) != want:
                    raise ValueError("a tokenizer changed the bytes of a text")
                columns.append(_ids(got))
            yield pa.RecordBatch.from_arrays([batch["seg"], batch["n"], *columns], names=["seg", "n", "a", "b"])
        pa.default_memory_pool().release_unused()

    out = segments.mapInArrow(encode, "seg string, n long, a array<int>, b array<int>")
    return kept(out.select(F.monotonically_increasing_id().alias("num"), "*"), "segments")


def _lengths(spark: SparkSession, tokens: list[list[bytes]]) -> DataFrame:
    """Byte lengths of both vocabularies: token (twice the id, and 1 for B), len."""
    rows = pa.table({
        "token": pa.array([2 * i + side for side, own in enumerate(tokens) for i in range(len(own))], pa.int32()), "len": pa.array([len(t) for own in tokens for t in own], pa.int32()),
    })
    return spark.createDataFrame(rows)


def _aligned(encoded: DataFrame, lengths: DataFrame) -> DataFrame:
    """For each segment (num, seg, n): n_a, n_b, its groups as text, and links, the pairs of tokens that end together."""

    def stream(column: str, side: int):
        return F.transform(column, lambda id, pos: F.struct(F.lit(side).alias("side"), pos.alias("pos"), (id * 2 + side).alias("token")))

    # Dealt by segment before tokens are rows; none of what follows moves them again.
    tokens = encoded.select("num", "a", "b").repartition("num").select("num", F.inline(F.concat(stream("a", 0), stream("b", 1))))
    until = Window.partitionBy("num", "side").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = tokens.join(F.broadcast(lengths), "token").withColumn("end", F.sum("len").over(until))
    # The equi-join of the two streams on (segment, end), as one grouping: a side has one token an end.
    met = ends.groupBy("num", "end").agg(*[F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{name}_{c}") for name, side in (("a", 0), ("b", 1)) for c in ("token", "pos")]).where("a_token IS NOT NULL AND b_token IS NOT NULL")
    # In the order of their ends, the number of cuts before a cut is its group's.
    links = met.groupBy("num").agg(F.array_sort(F.collect_list(F.struct("end", "a_token", "b_token", "a_pos", "b_pos"))).alias("links"))

    def part(ids: str, pos: str, link, at):
        before = F.when(at == 0, F.lit(-1)).otherwise(F.get("links", at - 1)[pos])
        return F.array_join(F.slice(F.col(ids), before + 2, link[pos] - before).cast("array<string>"), ",")

    groups = F.array_join(F.transform("links", lambda x, i: F.concat(part("a", "a_pos", x, i), F.lit("|"), part("b", "b_pos", x, i))), ";")
    pairs = F.transform("links", lambda x: F.shiftleft((x["a_token"] / 2).cast("long"), 32) + ((x["b_token"] - 1) / 2).cast("long"))
    both = encoded.select("num", "seg", "n", "a", "b").repartition("num").join(links, "num")
    return both.select("num", "seg", "n", F.size("a").alias("n_a"), F.size("b").alias("n_b"), groups.alias("groups"), pairs.alias("links"))


def _pairs(aligned: DataFrame) -> DataFrame:
    """pair, count (links of the corpus that hold it), is_best (none of the same b has more)."""
    counts = aligned.select("n", F.explode("links").alias("pair")).groupBy("pair").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    return written(counts.select("pair", "count", (F.col("count") == most).alias("is_best")), "pairs")


def _entries(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """What a text gets from one occurrence of a segment: seg, n_a, n_b, n_groups, n_best, count_sum, groups."""
    each = aligned.select("num", F.explode("links").alias("pair")).join(F.broadcast(pairs), "pair")
    sums = each.groupBy("num").agg(F.count(F.lit(1)).alias("n_groups"), F.sum(F.col("is_best").cast("long")).alias("n_best"), F.sum("count").alias("count_sum"))
    return aligned.join(sums, "num").select("seg", F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"), "n_groups", "n_best", "count_sum", "groups")


def _collect_garbage(spark: SparkSession) -> None:
    """Spark removes the shuffle files of finished jobs once the driver has collected what referred to them."""
    gc.collect()
    spark._jvm.System.gc()


COUNTS = ("n_a", "n_b", "n_groups", "n_best", "count_sum")
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _packed(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (block, columns), those of a block together, as compressed Arrow tables (block, packed): text is shuffled at half its size."""

    def pack(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table, sink = pa.Table.from_batches(held).select(columns), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table.combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, size = None, [], 0
        for batch in batches:
            blocks = np.asarray(batch["block"])
            begins = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1))
            for begin, end in zip(begins, [*begins[1:], len(batch)]):
                if held and (blocks[begin] != of or size >= PACK):
                    yield pack(of, held)
                    held, size = [], 0
                of, part = int(blocks[begin]), batch.slice(begin, end - begin)
                held.append(part)
                size += part.get_total_buffer_size() * len(part) // max(1, len(batch))
        if held:
            yield pack(of, held)

    return run


def _unpacked(rows: pa.Table, schema: pa.Schema) -> pa.Table:
    tables = [pa.ipc.open_stream(blob.as_buffer()).read_all().cast(schema) for blob in rows["packed"]]
    return pa.concat_tables(tables) if tables else schema.empty_table()


TEXTS = pa.schema([("doc_id", pa.int64()), ("marked", pa.string())])
ENTRIES = pa.schema([("seg", pa.string()), *[(c, pa.int64()) for c in COUNTS], ("groups", pa.string())])


def _assemble(texts: pa.Table, entries: pa.Table) -> pa.Table:
    """A block's texts, from the entries of its segments."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups", pa.string())])
    out = []
    there = pc.is_valid(texts["marked"])
    none = texts.filter(pc.invert(there))
    if len(none):
        zeros = pa.array(np.zeros(len(none), np.int64))
        out += pa.table([none["doc_id"].combine_chunks(), *[zeros] * 6, pa.array([""] * len(none))], schema=schema).to_batches()
    some = texts.filter(there)
    if len(some):
        words = pc.split_pattern(some["marked"].combine_chunks(), SPACE)
        offsets = np.asarray(words.offsets)
        at = pc.index_in(words.flatten(), value_set=entries["seg"].combine_chunks())
        places = np.asarray(at)
        groups, columns = entries["groups"].combine_chunks(), {c: np.asarray(entries[c]) for c in COUNTS}
        ids = some["doc_id"].combine_chunks()
        i = 0
        while i < len(some):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + AT_ONCE, side="right")) - 1)
            own = places[offsets[i] : offsets[j]]
            sums = {c: pa.array(np.add.reduceat(v[own], offsets[i:j] - offsets[i])) for c, v in columns.items()}
            strings = pc.binary_join(pa.ListArray.from_arrays(pa.array((offsets[i : j + 1] - offsets[i]).astype(np.int32)), groups.take(pa.array(own))), ";")
            del own
            out.append(pa.RecordBatch.from_arrays([ids[i:j], sums["n_a"], sums["n_b"], sums["n_groups"], sums["n_groups"], sums["n_best"], sums["count_sum"], strings], schema=schema))
            i = j
    return pa.Table.from_batches(out, schema=schema)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (`a1,a2|b1;a3|b2,b3`)."""
    spark = docs.sparkSession
    ship(spark)
    text = F.col(text_col).cast("string")
    blocks = docs.agg(F.ceil(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) / BLOCK_BYTES).alias("n")).first()["n"]
    marked = F.when((F.length(text) > 0) & ~F.contains(text, F.lit(SPACE)), F.regexp_replace(text, BORDER, SPACE))
    number = F.col(id_col).cast("long")
    # By id and text, so that copies of a text spread.
    rows = docs.select(number.alias("doc_id"), marked.alias("marked"), F.pmod(F.xxhash64(number, text), F.lit(max(1, int(blocks)))).cast("int").alias("block"))
    needs, needs_path = kept(rows.select("block", F.explode(F.split("marked", SPACE)).alias("seg")).groupBy("block", "seg").agg(F.count(F.lit(1)).alias("n")), "block-segments")
    _collect_garbage(spark)
    encoded, encoded_path = _encoded(needs.groupBy("seg").agg(F.sum("n").alias("n")), a_path, b_path)
    aligned, path = kept(_aligned(encoded, _lengths(spark, [byte_level(a_path)[1], pieces(b_path)[1]])), "aligned")
    drop_table(spark, encoded_path)
    _collect_garbage(spark)
    entries, entries_path = kept(_entries(aligned, _pairs(aligned)), "entries")
    drop_table(spark, path)
    _collect_garbage(spark)
    own = written(needs.select("block", "seg").join(entries, "seg").select("block", "seg", *COUNTS, "groups"), "block-entries")
    drop_table(spark, needs_path)
    drop_table(spark, entries_path)
    _collect_garbage(spark)
    sides = [df.sortWithinPartitions("block").mapInArrow(_packed(schema.names), "block int, packed binary") for df, schema in ((rows.select("block", "doc_id", "marked"), TEXTS), (own, ENTRIES))]

    def assemble(texts: pa.Table, some: pa.Table) -> pa.Table:
        out = _assemble(_unpacked(texts, TEXTS), _unpacked(some, ENTRIES))
        pa.default_memory_pool().release_unused()  # the worker stays, and would keep what it needed most
        return out

    return sides[0].groupBy("block").cogroup(sides[1].groupBy("block")).applyInArrow(assemble, SCHEMA)
