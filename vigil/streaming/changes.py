"""A stateful stream of changes: each record against the last one of its id, over all micro-batches so far.

The state of an id is its last content hash and how many contents it has had, so the stream tells new, modified and
unchanged records apart without reading a stored table. State is kept by Spark in the query's checkpoint: a stream that
is started again goes on where it stopped, and a micro-batch that is repeated after a failure starts from the state
before it. Ids are dealt by hash over a fixed number of buckets, and a bucket's records meet its state in one call, sorted
and compared by columns: a call an id would cost far more than its few records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.cdc import MODIFIED, NEW
from ..packaging import ship

UNCHANGED = "SIN_CAMBIO"
CHANGES = "id_registro string, seq long, hash_contenido string, hash_anterior string, version long, cambio string"


#: Buckets of ids. A micro-batch reads and writes the state of the buckets that it has records of; the number belongs to a
#: checkpoint, and a feed of very many ids should raise it.
BUCKETS = 512
#: A bucket's state: the last hash of each of its ids and how many contents that has had, as an Arrow stream.
KNOWN = pa.schema([("id", pa.string()), ("hash", pa.string()), ("version", pa.int64())])


def _read(state: GroupState) -> pa.Table:
    return pa.ipc.open_stream(bytes(state.get[0])).read_all() if state.exists else KNOWN.empty_table()


def _written(known: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, KNOWN) as to:
        to.write_table(known)
    return out.getvalue().to_pybytes()


def _codes(*columns: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The columns, one behind the other, as places in their distinct values; null is a value of its own."""
    chunks = [c for x in columns for c in (x.chunks if isinstance(x, pa.ChunkedArray) else [x])]
    found = pa.chunked_array(chunks, pa.string()).combine_chunks().dictionary_encode(null_encoding="encode")
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def _against_last(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known, rows = _read(state), pd.concat(list(frames), ignore_index=True)
    text = lambda c: pa.array(rows[c], pa.string(), from_pandas=True)
    n, (ids, names), (hashes, contents) = known.num_rows, _codes(known["id"], text("id")), _codes(known["hash"], text("hash"))
    # What each id had last: -1 for an id that is new.
    last, version = np.full(len(names), -1), np.zeros(len(names), np.int64)
    last[ids[:n]], version[ids[:n]] = hashes[:n], known["version"].to_numpy()
    order = np.lexsort((rows["seq"].to_numpy(), ids[n:]))  # by id and seq, of equal ones as they come
    own, now = ids[n:][order], hashes[n:][order]
    first = np.append(True, own[1:] != own[:-1])
    before = np.where(first, last[own], np.append(-1, now[:-1]))
    changed = np.cumsum(before != now)
    start = np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
    count = version[own] + changed - changed[start] + (before[start] != now[start])
    end = np.append(first[1:], True)
    last[own[end]], version[own[end]] = now[end], count[end]
    state.update((_written(pa.table({"id": names, "hash": contents.take(pa.array(last)), "version": version}, schema=KNOWN)),))
    of = lambda values, at, none=None: values.take(pa.array(at, pa.int64(), mask=none)).to_pandas()
    yield pd.DataFrame({
        "id_registro": of(names, own), "seq": rows["seq"].to_numpy()[order], "hash_contenido": of(contents, now), "hash_anterior": of(contents, before, before < 0), "version": count,
        "cambio": np.where(before < 0, NEW, np.where(before == now, UNCHANGED, MODIFIED)).astype(object),
    })


def change_feed(records: DataFrame, id_col: str = "id_registro", hash_col: str = "hash_contenido", seq_col: str = "seq", buckets: int = BUCKETS) -> DataFrame:
    """CHANGES of a stream of records, one row each.

    Within a micro-batch an id's records count in the order of seq_col (of equal ones, as they come), and micro-batches
    in theirs. A null hash is a content of its own, records without an id are those of one id. A bucket's records of one
    micro-batch meet in one task, so the trigger (files or rows a batch) bounds its memory.
    """
    ship(records.sparkSession)
    narrow = records.select(F.col(id_col).cast("string").alias("id"), F.col(seq_col).cast("long").alias("seq"), F.col(hash_col).cast("string").alias("hash"))
    dealt = narrow.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")).groupBy("bucket")
    return dealt.applyInPandasWithState(_against_last, CHANGES, "known binary", "append", GroupStateTimeout.NoTimeout)


def write_changes(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str, files: int = 1, **columns: str) -> StreamingQuery:
    """The change feed of all Parquet files that are in landing, `files` of them to a micro-batch, appended to out (Parquet,
    each micro-batch once); stops when it has taken all. Run again, it takes what has landed since."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).parquet(landing)
    return change_feed(stream, **columns).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
