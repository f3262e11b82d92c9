"""Best-fit packing planned on a length histogram.

Documents are encoded once and cut into pieces of at most `capacity` ids. The plan sees only how many pieces have each
length (at most `capacity` counts): best-fit decreasing over counts, which handles equal bins together, gives runs of
slots. A piece then takes the slot of its rank among the pieces of its length; the rank is dealt over buckets, so a
length that a third of all pieces have doesn't meet in one task.

In order, documents are packed by stretches of STRETCH rows, in the order in which they lie in the files read; each
stretch has a plan of its own, and its sequences follow those of the stretch before. So sequences follow the rows, at
the cost of the sequences left unfilled at the end of each stretch.

Defined cases: null text counts as empty, and an empty document is one piece holding the end id; rows repeated are
packed each on its own; an empty table gives an empty result; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, rank_within, ship, totals_before, written
from .encoding import encoder

#: Rows of a stretch.
STRETCH = 4096
#: Stretches whose sequences are counted up in one task.
STRETCHES = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RUNS = "run_length long, first_rank long, end_rank long, first_sequence long, in_sequence long, first_offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first piece may be shorter than capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def _pieces(path: str, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            of: list[int] = []
            for row, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                ids = np.concatenate([encode(text.as_py()).astype("<u4", copy=False), end])
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for to, x in zip(out, (doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))):
                        to.append(x)
                    of.append(row)
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            further = {name: batch.column(name).take(pa.array(of, pa.int64())) for name in batch.schema.names[2:]}
            yield pa.RecordBatch.from_arrays([*columns, *further.values()], ["doc_id", "piece", "start", "length", "ids_crc32", *further])

    return run


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows of RUNS.

    A run says: of the pieces of run_length, those of rank first_rank up to end_rank lie `in_sequence` to a sequence,
    from first_offset on, in sequences counted up from first_sequence.
    """
    open_bins: dict[int, list[tuple[int, int]]] = {}  # free ids -> (first sequence, number of sequences)
    runs: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            free = min((r for r in open_bins if r >= length), default=0)
            if free:
                first, n = open_bins[free].pop()
                if not open_bins[free]:
                    del open_bins[free]
            else:
                free, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = free // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - free))
                rank, left = rank + full * each, left - full * each
                if free - each * length:
                    open_bins.setdefault(free - each * length, []).append((first, full))
            if full < n:
                some = left  # fewer than `each` are left here
                if some:
                    runs.append((length, rank, rank + some, first + full, some, capacity - free))
                    rank, left = rank + some, 0
                    if free - some * length:
                        open_bins.setdefault(free - some * length, []).append((first + full, 1))
                    full += 1
                if full < n:
                    open_bins.setdefault(free, []).append((first + full, n - full))
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text"))
    pieces = written(source.mapInArrow(_pieces(tokenizer, capacity, end_id), PIECES), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = F.broadcast(spark.createDataFrame(plan(counts, capacity), RUNS))  # bounded by capacity, not by the input
    ranked = rank_within(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"])
    placed = ranked.join(runs, (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
    at = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(at / F.col("in_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + at % F.col("in_sequence") * F.col("length")).cast("long").alias("offset"),
    )


def _stretch(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["position", "piece"], kind="stable").reset_index(drop=True)
        of_length = {length: rows.to_numpy() for length, rows in pieces.groupby("length").groups.items()}
        sequence, offset = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for length, first, end, first_sequence, each, first_offset in plan({int(k): len(v) for k, v in of_length.items()}, capacity):
            rows, at = of_length[length][first:end], np.arange(end - first)
            sequence[rows], offset[rows] = first_sequence + at // each, first_offset + at % each * length
        # Sequences are numbered by the place of their first piece.
        first_rows = np.sort(np.flatnonzero(offset == 0))
        number = np.empty(len(first_rows), np.int64)
        number[sequence[first_rows]] = np.arange(len(first_rows))
        return pieces.assign(sequence_id=number[sequence], offset=offset)

    return run


def pack_in_order(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As pack, with sequences in the order of the rows of docs: by file and place in it where docs is read from files."""
    spark = docs.sparkSession
    ship(spark)
    own = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text")]
    try:
        source = docs.select(*own, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:  # not read from files
        source = docs.select(*own, F.lit("").alias("file"), F.monotonically_increasing_id().alias("row"))
    pieces = written(source.mapInArrow(_pieces(tokenizer, capacity, end_id), PIECES + ", file string, row long"), "ordered-pieces")
    # Names of one folder's files differ in length only where the number of the file has more digits. Sorting deals them over parts in order.
    files = pieces.groupBy("file").agg((F.max("row") + 1).alias("n")).withColumn("digits", F.length("file")).orderBy("digits", "file")
    files = totals_before(written(files.withColumn("part", F.spark_partition_id()), "ordered-files"), "part", ["digits", "file"], "n", "before").select("file", "before")
    placed = pieces.join(checked(files), "file").withColumn("position", F.col("before") + F.col("row")).withColumn("stretch", F.floor(F.col("position") / STRETCH).cast("long"))
    placed = placed.select("doc_id", "piece", "start", "length", "ids_crc32", "position", "stretch")
    packed = written(placed.groupBy("stretch").applyInPandas(_stretch(capacity), PIECES + ", position long, stretch long, sequence_id long, offset long"), "packed-stretches")
    shifts = packed.groupBy("stretch").agg((F.max("sequence_id") + 1).alias("n")).withColumn("part", F.floor(F.col("stretch") / STRETCHES))
    shifts = totals_before(written(shifts, "stretches"), "part", ["stretch"], "n", "shift").select("stretch", "shift")
    return packed.join(checked(shifts), "stretch").select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence_id") + F.col("shift")).alias("sequence_id"), "offset")
