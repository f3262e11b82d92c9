"""Join sides of unknown size: broadcast after counting, shuffle beyond the bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A list side is broadcast up to this many rows; a longer one is shuffled, with its blocks salted.
BROADCAST_ROWS = 200_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if fits(df, rows) else df
