"""Dates in the many forms of the public lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACES, strip

# Texts that stand for no date, and the accepted forms in order (shape, Spark's pattern).
NO_DATE = ["", "none", "null", "n/a", "nd", "sin fecha"]
FORMS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3,9} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{3,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{4}-\d{1,2}$", "yyyy-M"),
    (r"^\d{4}$", "yyyy"),
]
DATETIME = r"^(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}"


def parse_date(value: Column, datetimes: bool = False) -> Column:
    """A date from text: the first form that fits, day before month; else the first year 19xx or 20xx as its first of January.

    Six or seven digits read as year, month and day of one or two digits. datetimes: also take an ISO time's date,
    which otherwise falls back to the year.
    """
    v = F.regexp_replace(strip(value.cast("string")), SPACES, " ")
    tries = [F.when(F.regexp_like(v, F.lit(shape)), F.try_to_date(v, pattern)) for shape, pattern in FORMS]
    six = F.when(F.regexp_like(v, F.lit(r"^\d{4}[1-9][1-9]$")), F.try_to_date(F.regexp_replace(v, r"^(\d{4})(\d)(\d)$", "$1-$2-$3"), "yyyy-M-d"))
    seven = F.when(F.regexp_like(v, F.lit(r"^\d{4}(0[1-9]|1[0-2])[1-9]$")), F.try_to_date(F.regexp_replace(v, r"^(\d{4})(\d\d)(\d)$", "$1-$2-$3"), "yyyy-M-d"))
    other = F.when(F.regexp_like(v, F.lit(r"^\d{4}[1-9]([1-2]\d|3[01])$")), F.try_to_date(F.regexp_replace(v, r"^(\d{4})(\d)(\d\d)$", "$1-$2-$3"), "yyyy-M-d"))
    year = F.nullif(F.regexp_extract(v, r"\b((?:19|20)\d{2})\b", 1), F.lit(""))
    iso = [F.try_to_date(F.nullif(F.regexp_extract(v, DATETIME, 1), F.lit("")), "yyyy-MM-dd")] if datetimes else []
    found = F.coalesce(*iso, *tries[:5], six, seven, other, *tries[5:], F.try_to_date(year, "yyyy"))
    return F.when(~F.lower(v).isin(NO_DATE), found)
