"""Delimited files, also zipped, parsed in many tasks a file although quoted fields may hold line ends.

A record's id holds its number in the file, blank rows counted, and whether a line begins a record depends on all quotes
before it. So files are cut into chunks of whole lines, and every chunk is summed up speculatively, for each delimiter
and for either state it may begin in (outside or inside a quoted field): the state it ends in, and how many records
begin in it. A scan over these few numbers, in the order of a file's chunks, then fixes each chunk's true state and the
number of its first record, and chunks are parsed independently. A record that lies in several chunks is put together
from its pieces.

Chunks are a table of their own, written once, so what was summed up is what is parsed, however the files are split. A
zip archive can't be entered in its middle: it is unpacked in one task, as a stream, and parsed in many.

Encoding (UTF-8, with or without a mark, else Latin-1), delimiter and columns are found from each file. A lone carriage
return outside quotes counts as a space. A quoted field that is never closed runs to the end of its file.
"""

from __future__ import annotations

import csv
import io
import re
import sys
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import checked
from ..packaging import ship
from ..schemas import NATURAL
from ..staging import staged
from .xml_lists import _raw

# What a column's header may contain, in order of preference.
HEADERS = {
    "nombres": ["NOMBRE", "NOMBRES", "PRIMER_NOMBRE", "FIRST_NAME"],
    "apellidos": ["APELLIDO", "APELLIDOS", "PRIMER_APELLIDO"],
    "cedula": ["CEDULA", "NRO_CEDULA", "NUMERO_CEDULA", "DOCUMENTO", "NRO_DOC", "IDENTIFICACION"],
    "tipo_sancion": ["TIPO_SANCION", "SANCION", "DELITO", "CARGO", "FALTA", "DESCRIPCION_SANCION"],
    "fecha_sancion": ["FECHA_SANCION", "FECHA_CONDENA", "FECHA_EJECUTORIA", "FECHA_INICIO"],
    "fecha_vencimiento": ["FECHA_VENCIMIENTO", "FECHA_FIN", "FECHA_HASTA", "FECHA_TERMINACION"],
    "estado": ["ESTADO", "VIGENTE", "ACTIVO", "STATUS"],
}
ACTIVE = ["VIGENTE", "ACTIVO", "ACTIVE", "S", "SI", "YES", "1", "TRUE", ""]
DELIMITERS = ",;|"
MARK = b"\xef\xbb\xbf"

#: Bytes of a chunk, beyond which it ends with its line, and of the file's beginning that are kept to find its columns.
CHUNK, HEAD = 1 << 20, 1 << 18
#: Inside a quoted field, up to and with the quote that closes it.
CLOSE = re.compile(rb'(?:[^"]+|"")*+"')


def delimiter(text: str) -> str:
    """By the first 2000 characters: a comma if it leads both others, else a bar if it leads semicolons, else a semicolon."""
    n = {c: text[:2000].count(c) for c in DELIMITERS}
    return "," if n[","] > max(n[";"], n["|"]) else "|" if n["|"] > n[";"] else ";"


def column_of(header: list[str], wanted: list[str]) -> int | None:
    """The first column whose header holds, or is part of, the earliest wanted name that fits any."""
    names = [h.upper().strip() for h in header]
    return next((i for w in wanted for i, h in enumerate(names) if w in h or h in w), None)


def ends_inside(line: bytes, sep: bytes, inside: bool) -> bool:
    """Whether a line that begins inside a quoted field, or outside, ends inside one. A quote opens a field only at its beginning."""
    at = 0
    while True:
        if inside or line[at : at + 1] == b'"':
            closed = CLOSE.match(line, at + (not inside))
            if not closed:
                return True
            at, inside = closed.end(), False
        at = line.find(sep, at) + 1
        if not at:
            return False


def summary(lines: list[bytes]) -> dict[str, list]:
    """Of a chunk, by delimiter (lead) and by delimiter and state at its beginning (the rest): whether it ends inside a
    quoted field, how many records begin in it, where the last of them begins if it doesn't end here (else -1), and
    where the first record begins if the chunk begins inside one."""
    out: dict[str, list] = {"inside": [], "begun": [], "open": [], "lead": []}
    size = sum(map(len, lines)) + len(lines)
    quoted = any(b'"' in line for line in lines)
    for sep in DELIMITERS.encode():
        for first in (False, True):
            inside, begun, last, lead, at = first, 0, -1, size, 0
            if quoted:
                for line in lines:
                    if not inside:
                        begun, last = begun + 1, at
                        lead = min(lead, at)
                    if b'"' in line:
                        inside = ends_inside(line, bytes([sep]), inside)
                    at += len(line) + 1
            elif not first:
                begun = len(lines)
            out["inside"].append(inside)
            out["begun"].append(begun)
            out["open"].append(last if inside else -1)
            if first:
                out["lead"].append(lead)
    return out


CHUNKS = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("content", pa.binary()), ("head", pa.binary()), ("utf8", pa.bool_()),
    ("inside", pa.list_(pa.bool_())), ("begun", pa.list_(pa.int64())), ("open", pa.list_(pa.int64())), ("lead", pa.list_(pa.int64())),
])
CHUNK_COLUMNS = "file string, block long, chunk long, content binary, head binary, utf8 boolean, inside array<boolean>, begun array<long>, open array<long>, lead array<long>"


def _chunk(file: str, block: int, chunk: int, lines: list[bytes]) -> pa.RecordBatch:
    first = not block and not chunk
    if first and lines[0].startswith(MARK):
        lines = [lines[0][len(MARK) :], *lines[1:]]
    content = b"\n".join(lines) + b"\n"
    try:
        content.decode()
        utf8 = True
    except UnicodeDecodeError:
        utf8 = False
    row = {"file": file, "block": block, "chunk": chunk, "content": content, "head": content[:HEAD] if first else None, "utf8": utf8} | summary(lines)
    return pa.RecordBatch.from_pylist([row], CHUNKS)


def chunked(lines: Iterable[tuple[str, int, bytes]], most: int) -> Iterator[pa.RecordBatch]:
    """Chunks of `most` bytes or one line more from lines (file, block, line), in their order."""
    of, held, size, chunk = None, [], 0, 0
    for file, block, line in lines:
        if held and ((file, block) != of or size >= most):
            yield _chunk(*of, chunk, held)
            chunk, held, size = chunk + 1, [], 0
        if (file, block) != of:
            of, chunk = (file, block), 0
        held.append(line)
        size += len(line) + 1
    if held:
        yield _chunk(*of, chunk, held)


def _of_lines(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chunked(((f, b, line) for batch in batches for f, b, line in zip(*(c.to_pylist() for c in batch.columns))), most)

    return run


def member_lines(content: bytes, zipped: bool) -> Iterator[bytes]:
    """The lines of a file or, if it is zipped, of the first .csv or .txt file in it; none if there is none or it is no
    archive. An archive that breaks off within the file is an error: part of a list must not pass for the whole."""
    stream = io.BytesIO(content)
    if zipped:
        try:
            z = zipfile.ZipFile(stream)
        except zipfile.BadZipFile:
            return
        name = next((n for n in z.namelist() if n.lower().endswith((".csv", ".txt"))), None)
        if name is None:
            return
        stream = z.open(name)
    for line in stream:
        yield line.removesuffix(b"\n")


def _of_files(zipped: bool, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from chunked(((path.as_py(), 0, line) for line in member_lines(content.as_py(), zipped)), most)

    return run


def records(text: str, sep: str) -> list[list[str]]:
    csv.field_size_limit(sys.maxsize)
    try:
        return list(csv.reader(io.StringIO(text), delimiter=sep))
    except csv.Error:  # a carriage return within a line
        return list(csv.reader(io.StringIO(re.sub(r"\r(?!\n)", " ", text)), delimiter=sep))


STATES = "file string, block long, chunk long, encoding string, sep string, columns array<int>, state int, first_row long, ends_inside boolean"


def _states(chunks: pa.Table) -> pa.Table:
    """The scan over a file's chunks, and what the file's beginning and all its bytes say about it."""
    rows = sorted(chunks.to_pylist(), key=lambda r: (r["block"], r["chunk"]))
    encoding = "utf-8" if all(r["utf8"] for r in rows) else "latin-1"
    head = (rows[0]["head"] or b"").decode(encoding, "replace")
    sep = delimiter(head)
    header = next(iter(records(head, sep)), [])
    columns = [-1 if k is None else k for k in (column_of(header, wanted) for wanted in HEADERS.values())]
    state, row, out = 0, 0, []
    for r in rows:
        at = 2 * DELIMITERS.index(sep) + state
        out.append({"file": r["file"], "block": r["block"], "chunk": r["chunk"], "encoding": encoding, "sep": sep, "columns": columns, "state": state, "first_row": row, "ends_inside": r["inside"][at]})
        row, state = row + r["begun"][at], int(r["inside"][at])
    return pa.Table.from_pylist(out, pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("encoding", pa.string()), ("sep", pa.string()), ("columns", pa.list_(pa.int32())), ("state", pa.int32()), ("first_row", pa.int64()),
        ("ends_inside", pa.bool_())]))


ROWS = "file string, row long, " + ", ".join(f"`{f}` string" for f in HEADERS)
_ROWS = pa.schema([("file", pa.string()), ("row", pa.int64()), *[(f, pa.string()) for f in HEADERS]])


def _fields(file: str, first: int, found: list[list[str]], columns: list[int]) -> list[dict]:
    """The rows that aren't blank; row 0 is the header."""
    return [
        {"file": file, "row": n} | {f: row[k].strip() if 0 <= k < len(row) else "" for f, k in zip(HEADERS, columns)}
        for n, row in enumerate(found, first) if n and any(c.strip() for c in row)
    ]


def _bounds(r: dict) -> tuple[int, int]:
    """Where the records that lie wholly in a chunk begin and end."""
    k = DELIMITERS.index(r["sep"])
    begin, last = r["lead"][k] if r["state"] else 0, r["open"][2 * k + r["state"]]
    return begin, last if last >= 0 else len(r["content"])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            (r,) = batch.slice(i, 1).to_pylist()
            begin, end = _bounds(r)
            rows = _fields(r["file"], r["first_row"], records(r["content"][begin:end].decode(r["encoding"]), r["sep"]), r["columns"])
            yield pa.RecordBatch.from_pylist(rows, _ROWS)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What chunks hold of records that lie in several."""
    for batch in batches:
        for i in range(len(batch)):
            (r,) = batch.slice(i, 1).to_pylist()
            begin, end = _bounds(r)
            k = 2 * DELIMITERS.index(r["sep"]) + r["state"]
            parts = [(r["first_row"] - 1, r["content"][:begin])] if r["state"] else []
            parts += [(r["first_row"] + r["begun"][k] - 1, r["content"][end:])] if r["open"][k] >= 0 else []
            same = {c: [r[c]] * len(parts) for c in ("file", "block", "chunk", "encoding", "sep", "columns")}
            yield pa.RecordBatch.from_pydict(
                same | {"row": [p[0] for p in parts], "piece": [p[1] for p in parts]},
                pa.schema([("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("encoding", pa.string()), ("sep", pa.string()), ("columns", pa.list_(pa.int32())), ("row", pa.int64()), ("piece", pa.binary())]))


def _stitch(pieces: pa.Table) -> pa.Table:
    rows = sorted(pieces.to_pylist(), key=lambda r: (r["block"], r["chunk"]))
    text = b"".join(r["piece"] for r in rows).decode(rows[0]["encoding"])
    return pa.Table.from_pylist(_fields(rows[0]["file"], rows[0]["row"], records(text, rows[0]["sep"]), rows[0]["columns"]), _ROWS)


def _parsed(chunks: DataFrame) -> DataFrame:
    """(file, row, fields) of all rows that aren't blank."""
    chunks = staged(chunks, "chunks")
    place = ["file", "block", "chunk"]
    states = staged(chunks.select(*place, "head", "utf8", "inside", "begun").groupBy("file").applyInArrow(_states, STATES), "chunk-states")  # one row a chunk
    whole = chunks.drop("head", "utf8", "inside").join(checked(states), place)
    rows = whole.mapInArrow(_parse, ROWS)
    shared = (F.col("state") == 1) | F.col("ends_inside")
    if states.where(shared).isEmpty():
        return rows
    pieces = whole.where(shared).mapInArrow(_pieces, "file string, block long, chunk long, encoding string, sep string, columns array<int>, row long, piece binary")
    return rows.unionByName(pieces.groupBy("file", "row").applyInArrow(_stitch, ROWS))


def read_delimited(spark: SparkSession, path: str, source: str, zipped: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Person sanctions from the delimited files at path."""
    if zipped:
        return delimited(spark.read.format("binaryFile").load(path), source, zipped, chunk)
    ship(spark)
    # Spark splits the files into blocks of lines; a line's bytes come as they are.
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    return _sanctions(_parsed(lines.mapInArrow(_of_lines(chunk), CHUNK_COLUMNS)), source)


def delimited(files: DataFrame, source: str, zipped: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Person sanctions from delimited files (path, content); zipped: each file is an archive with one."""
    ship(files.sparkSession)
    return _sanctions(_parsed(files.select("path", "content").mapInArrow(_of_files(zipped, chunk), CHUNK_COLUMNS)), source)


def _sanctions(rows: DataFrame, source: str) -> DataFrame:
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    return _raw(
        rows.where("nombres <> '' OR cedula <> ''"), fuente=F.lit(source), id_fuente_original=F.concat_ws("_", F.lit(source), F.col("row").cast("string"), F.col("cedula")), tipo_sujeto=F.lit(NATURAL),
        nombres=F.coalesce(given("nombres"), given("apellidos")), apellidos=F.when(F.col("nombres") != "", given("apellidos")), nacionalidad=F.array(F.lit("CO")),
        numero_documento=given("cedula"), tipo_sancion=F.coalesce(given("tipo_sancion"), F.lit(f"SANCION {source}")), fecha_sancion=given("fecha_sancion"),
        fecha_vencimiento=given("fecha_vencimiento"), activo=F.upper("estado").isin(ACTIVE),
    )
