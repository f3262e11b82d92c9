"""Fill-in-the-middle transformation: texts are cut in three at word borders and rearranged, by DuckDB SQL over Arrow batches.

Every Arrow batch is registered with an in-process DuckDB and rearranged by one statement: regexp_extract_all gives the
units, list_slice and array_to_string the parts, and sha256 of seed and id the draws, so a row's result depends on
nothing but its id and text. No row passes through Python code, and rows don't move between tasks. A batch is handed to
DuckDB in slices of at most SLICE_BYTES of text (a longer text is a slice of its own), so memory is bounded by the slice.

Units are `[white space]*[other]+|[white space]+` with the six ASCII white-space characters, so joined units are the
text. A text is left plain if it is empty, holds one of the three marks, or is drawn so.

Defined cases: a null text counts as empty; a null id draws like the empty string; repeated rows give equal rows; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Bytes of text that DuckDB gets at once; its lists of units take some twenty times as much.
SLICE_BYTES = 4 << 20
#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def statement(seed: int, fim_percent: int, spm_percent: int) -> str:
    """The SQL over a view `batch` (id, text) without nulls in text."""
    draws = ", ".join(f"('0x' || substr(hex, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return rf"""
        WITH units AS (
            SELECT id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                   sha256('{seed}:' || coalesce(id::VARCHAR, '')) AS hex FROM batch),
        drawn AS (SELECT id, text, u, len(u)::BIGINT AS n, {draws} FROM units),
        cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
                   CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {fim_percent} THEN 'plain'
                        WHEN h4 % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form
            FROM drawn),
        parts AS (
            SELECT id, n, form, text,
                   CASE WHEN form <> 'plain' THEN array_to_string(list_slice(u, 1, c1), '') END AS p,
                   CASE WHEN form <> 'plain' THEN array_to_string(list_slice(u, c1 + 1, c2), '') END AS m,
                   CASE WHEN form <> 'plain' THEN array_to_string(list_slice(u, c2 + 1, n), '') END AS s
            FROM cut)
        SELECT id AS doc_id, n, form, length(p)::BIGINT AS prefix_chars, length(m)::BIGINT AS middle_chars,
               CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                         ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END AS output
        FROM parts
    """


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most SLICE_BYTES of text; a longer text is alone."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch["text"]), dtype=np.int64))
    start = 0
    while start < len(batch):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def rearrange(batches: Iterator[pa.RecordBatch], sql: str) -> Iterator[pa.RecordBatch]:
    import duckdb

    # No setting of the machine's is read, and nothing is written beside memory.
    con = duckdb.connect(":memory:")
    con.execute("SET threads = 1")
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    for batch in batches:
        for part in slices(batch):
            con.register("batch", pa.Table.from_batches([part]))
            yield from con.sql(sql).to_arrow_table().cast(schema).to_batches()
            con.unregister("batch")
    con.close()


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """One row for each row of docs: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sql = statement(seed, fim_percent, spm_percent)
    return source.mapInArrow(lambda batches: rearrange(batches, sql), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone. A text that was rearranged holds no mark, so each mark's first place is its own."""
    first = F.substr(output, F.lit(len(PREFIX) + 1))

    def parts(mark: str) -> tuple[Column, Column, Column]:
        """What stands before mark, between mark and MIDDLE, and after."""
        rest = F.split_part(first, F.lit(mark), F.lit(2))
        return F.split_part(first, F.lit(mark), F.lit(1)), F.split_part(rest, F.lit(MIDDLE), F.lit(1)), F.split_part(rest, F.lit(MIDDLE), F.lit(2))

    p, s, m = parts(SUFFIX)
    s2, p2, m2 = parts(PREFIX)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)
