"""Pages of search hits in JSON: one file a page, read together."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_word_and_rest, non_empty
from ..schemas import LEGAL, NATURAL
from ..staging import staged
from .xml_lists import _raw, sound

#: A page's hits stay texts until each is parsed by itself, so one that is no hit spoils no other.
PAGE = "hits struct<total: string, hits: array<string>>"
HIT = (
    "_id string, _source struct<entity_name: string, display_names: string, title: string, name: string, file_num: string, release_no: string, display_date_filed: string, period_of_report: string, "
    "date_filed: string, form_type: string, type: string>"
)
# Words that mark a company or a person.
COMPANY = (
    r"(?i)\b(LLC|INC|CORP|CORPORATION|LIMITED|LTD|S\.A\.|S\.A|GMBH|B\.V\.|PLC|COMPANY|CO\.|GROUP|HOLDINGS|PARTNERS|ASSOCIATES|ENTERPRISES|BANK|FUND|TRUST|FOUNDATION|INSTITUTE|SERVICES|SOLUTIONS|"
    r"TECHNOLOGIES|INTERNATIONAL|GLOBAL|WORLDWIDE)\b"
)
PERSON = r"(?i)\b(JR\.|SR\.|III|II|MR\.|MRS\.|DR\.)\b"


def subject_type(name: Column) -> Column:
    """Company by its words, else person by its titles, else person if of at most three words."""
    words = F.size(F.filter(F.split(name, r"(?U)\s+"), lambda w: w != ""))
    return F.when(F.regexp_like(name, F.lit(COMPANY)), LEGAL).when(F.regexp_like(name, F.lit(PERSON)) | (words <= 3), NATURAL).otherwise(LEGAL)


def _one(c: Column) -> Column:
    """A text, or the first of a list of texts (which the reader gives as JSON)."""
    first = F.get(F.from_json(c, "array<string>"), 0)
    return F.when(c.startswith("["), first).otherwise(c)


def read_hits(spark: SparkSession, path: str, multi_line: bool = True, rejects: list[DataFrame] | None = None) -> DataFrame:
    """Records of the pages: a page a file, or a page a line. Pages and hits that can't be parsed are set aside."""
    read = spark.read.option("multiLine", multi_line).option("columnNameOfCorruptRecord", "__bad").schema(PAGE + ", __bad string").json(path)
    pages = sound(staged(read, "pages"), "__bad", "malformed page", rejects)
    hit = pages.select(F.explode("hits.hits").alias("text")).where("text IS NOT NULL")
    hit = hit.withColumn("h", F.from_json("text", HIT + ", __bad string", {"columnNameOfCorruptRecord": "__bad"})).withColumn("__bad", F.when(F.col("h.__bad").isNotNull() | F.col("h").isNull(), F.col("text")))
    hit = sound(hit, "__bad", "malformed hit", rejects).select("h._id", "h._source.*")
    given = F.coalesce(*[F.nullif(F.nullif(F.col(c), F.lit("")), F.lit("[]")) for c in ("entity_name", "display_names", "title", "name")])
    x = hit.withColumn("__name", non_empty(_one(given))).where("__name IS NOT NULL").withColumn("__type", subject_type(F.col("__name")))
    first, rest = first_word_and_rest(F.col("__name"))
    natural = F.col("__type") == NATURAL
    pick = lambda *names: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names])
    return _raw(
        x, fuente=F.lit("FCPA"), id_fuente_original=_one(F.coalesce(pick("file_num", "release_no", "_id"), F.lit(""))), tipo_sujeto=F.col("__type"),
        nombres=F.when(natural, first).otherwise(F.col("__name")), apellidos=F.when(natural, rest),
        tipo_sancion=F.concat(F.lit("FCPA "), F.coalesce(pick("form_type", "type"), F.lit("FCPA"))), fecha_sancion=pick("display_date_filed", "period_of_report", "date_filed"),
    )


def more_pages(body: bytes, page: int, size: int) -> bool:
    """Whether pages follow page `page` (from 0) of `size` hits: it has hits, and announces more than came so far."""
    try:
        hits = json.loads(body).get("hits") or {}
    except (ValueError, AttributeError):
        return False
    total = hits.get("total") or 0
    total = total.get("value") or 0 if isinstance(total, dict) else int(total)
    return bool(hits.get("hits")) and (page + 1) * size < total


def total_hits(spark: SparkSession, path: str) -> DataFrame:
    """The number of hits each page announces, as a number or as {"value": number}: (file, total, n_hits)."""
    pages = spark.read.option("multiLine", True).schema(PAGE).json(path)
    total = F.coalesce(F.get_json_object("hits.total", "$.value").cast("long"), F.expr("try_cast(hits.total AS long)"), F.lit(0))
    return pages.select(F.col("_metadata.file_path").alias("file"), total.alias("total"), F.coalesce(F.size("hits.hits"), F.lit(0)).alias("n_hits"))
