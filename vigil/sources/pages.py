"""Landed pages as a Spark data source, and HTML tables as a table function for SQL.

    pages = spark.read.format("vigil_pages").option("pattern", "*.html").load("/shared/landing/WORLD_BANK")
    SELECT p.page_id, t.* FROM pages p, LATERAL html_table_rows(p.html) t
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.functions import udtf

from .files import TABLE_HEADERS, table_rows

PAGES = "path string, page int, content binary"
_PAGES = pa.schema([("path", pa.string()), ("page", pa.int32()), ("content", pa.binary())])
#: Bytes of small pages that one task reads; a larger page is a task of its own.
TASK_BYTES = 8 << 20


class Pages(InputPartition):
    def __init__(self, pages: list[tuple[str, int]]):
        self.pages = pages


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        folder = options["path"].removeprefix("file://").removeprefix("file:")
        self.folder, self.pattern, self.task_bytes = folder, options.get("pattern", "*"), int(options.get("taskBytes", TASK_BYTES))

    def partitions(self) -> list[Pages]:
        """Pages in the order of their names; neighbours share a task up to task_bytes."""
        names = sorted(n for n in os.listdir(self.folder) if fnmatch.fnmatch(n, self.pattern) and not n.startswith(("_", ".")))
        out, size = [], 0
        for k, name in enumerate(names):
            path = os.path.join(self.folder, name)
            own = os.path.getsize(path)
            if not out or size + own > self.task_bytes:
                out.append(Pages([]))
                size = 0
            out[-1].pages.append((path, k))
            size += own
        return out or [Pages([])]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        for path, page in partition.pages:
            with open(path, "rb") as f:
                yield pa.RecordBatch.from_pydict({"path": [path], "page": [page], "content": [f.read()]}, _PAGES)


class PagesSource(DataSource):
    """Pages that fetch.land_pages has landed, one row each, in a folder that all machines mount. Options: path, pattern, taskBytes."""

    @classmethod
    def name(cls) -> str:
        return "vigil_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> PagesReader:
        return PagesReader(self.options)


class TableRows:
    """The rows of a page's first table: their number and the fields of files.TABLE_HEADERS; none for null."""

    def eval(self, html: str):
        if html is not None:
            for r in table_rows(html)[0]:
                yield (r["row"], *(r[f] for f in TABLE_HEADERS))


html_table_rows = udtf(TableRows, returnType="row int, " + ", ".join(f"`{f}` string" for f in TABLE_HEADERS))


def register(spark: SparkSession) -> None:
    """The format vigil_pages and the table function html_table_rows, for the session."""
    from ..packaging import ship

    ship(spark)
    spark.dataSource.register(PagesSource)
    spark.udtf.register("html_table_rows", html_table_rows)
