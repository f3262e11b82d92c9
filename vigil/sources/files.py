"""HTML tables: whole pages through Arrow, parsed with the standard library."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import normalize_text
from ..packaging import ship
from ..schemas import LEGAL
from .xml_lists import _raw

# What a column's header may contain, in order of preference.
TABLE_HEADERS = {
    "name": ["FIRM", "NAME", "EMPRESA"], "country": ["COUNTRY", "PAIS"], "from": ["FROM", "DESDE", "START"], "to": ["TO", "UNTIL", "HASTA", "END"], "grounds": ["GROUND", "REASON", "BASIS"],
}
INDEFINITE = ["indefinite", "indefinido"]
DIV_TABLE = "table|grid|list"
NEXT_PAGE = r"next|siguiente|›|»"


class _Area:
    """The rows of the first element of a kind: a table, or a div that is laid out like one."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.depth, self.seen, self.done = 0, False, False
        self.cell: list[str] | None = None

    def close_cell(self):
        if self.cell is not None and self.rows:
            self.rows[-1].append("".join(x.strip() for x in self.cell))
        self.cell = None


class _Tables(HTMLParser):
    """Cells of the first table or, in a page without any, of the first div whose class names one, and whether the page
    links to a next one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.areas = {"table": _Area(), "div": _Area()}
        self.next = False
        self._link: list[str] | None = None

    @property
    def rows(self) -> list[list[str]]:
        return self.areas["table" if self.areas["table"].seen else "div"].rows

    def handle_starttag(self, tag, attrs):
        marks = dict(attrs).get("class") or ""
        if re.search("next|pagination", marks, re.I):
            self.next = True
        if tag == "a":
            self._link = []
        for kind, area in self.areas.items():
            if tag == kind and not area.done and (area.depth or kind == "table" or re.search(DIV_TABLE, marks, re.I)):
                area.depth, area.seen = area.depth + 1, True
            elif area.depth and tag == "tr":
                area.close_cell()
                area.rows.append([])
            elif area.depth and tag in ("td", "th"):
                area.close_cell()
                area.cell = []

    def handle_endtag(self, tag):
        if tag == "a" and self._link is not None:
            self.next = self.next or bool(re.search(NEXT_PAGE, "".join(self._link), re.I))
            self._link = None
        for kind, area in self.areas.items():
            if area.depth and tag in ("td", "th", "tr", kind):
                area.close_cell()
                if tag == kind:
                    area.depth -= 1
                    area.done = not area.depth

    def handle_data(self, data):
        for area in self.areas.values():
            if area.cell is not None:
                area.cell.append(data)
        if self._link is not None:
            self._link.append(data)


def table_rows(html: str) -> tuple[list[dict], bool]:
    """The fields of TABLE_HEADERS (None where the column is missing) and row number of each row, and whether a next page is linked."""
    page = _Tables()
    page.feed(html)
    page.close()
    if not page.rows:
        return [], False
    header = [h.upper() for h in page.rows[0]]
    at = {f: next((i for i, h in enumerate(header) if any(w in h for w in wanted)), 0 if f == "name" else None) for f, wanted in TABLE_HEADERS.items()}
    out = []
    for i, row in enumerate(page.rows[1:], 1):
        cells = {f: None if k is None else (row[k] if k < len(row) else "") for f, k in at.items()}
        if len(row) >= 2 and cells["name"]:
            out.append({"row": i} | cells)
    return out, page.next


def _parsed(df: DataFrame, parse: Callable[[bytes], list[dict]], fields: list[str]) -> DataFrame:
    """(file, row, fields) from (path, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                yield pd.DataFrame([{"file": path} | r for r in parse(content)], columns=["file", "row", *fields])

    ship(df.sparkSession)
    return df.select("path", "content").mapInPandas(run, "file string, row long, " + ", ".join(f"`{f}` string" for f in fields))


def debarred(pages: DataFrame, today: str) -> DataFrame:
    """Debarred firms from (path, content) of HTML pages; of rows with the same name and start date, the first by page and row stays."""
    x = _parsed(pages, lambda c: table_rows(bytes(c).decode("utf-8", "replace"))[0], list(TABLE_HEADERS))
    start = parse_date(F.col("from"))
    first = Window.partitionBy(normalize_text(F.col("name")), start).orderBy("file", "row")
    x = x.withColumn("__k", F.row_number().over(first)).where("__k = 1")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    open_end = F.lower(text("to")).isin(INDEFINITE)
    ends = parse_date(F.col("to"))
    return _raw(
        x, fuente=F.lit("WORLD_BANK"), id_fuente_original=F.concat(F.lit("WB_"), F.col("row").cast("string"), F.lit("_"), F.substring("name", 1, 30)),
        tipo_sujeto=F.lit(LEGAL), nombres=F.col("name"), nacionalidad=F.filter(F.array(F.col("country")), lambda c: F.length(c) > 0),
        tipo_sancion=F.when(F.col("grounds").isNull(), "DEBARMENT").otherwise(F.coalesce(F.nullif(F.col("grounds"), F.lit("")), F.lit("WORLD BANK DEBARMENT"))), fecha_sancion=text("from"),
        fecha_vencimiento=F.when(~open_end, text("to")), activo=F.when(open_end | ends.isNull(), True).otherwise(ends >= F.lit(today).cast("date")),
    )


def read_debarred(spark: SparkSession, path: str, today: str) -> DataFrame:
    return debarred(spark.read.format("binaryFile").load(path), today)


def has_next(html: str) -> bool:
    return table_rows(html)[1]
