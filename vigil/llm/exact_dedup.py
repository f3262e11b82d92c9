"""Exact dedup: rows are grouped by a 128-bit content hash, and bytes are compared inside groups.

The hash table that is grouped is narrow (id, 16-byte hash, digest), so text moves only for the rows whose hash occurs
more than once: the scan finds them by the broadcast hashes, or by a filter of fixed size where those are too many to
broadcast (it lets one other row in 200 pass). They are compared by the least and greatest text of each group, which
combine before the shuffle: a group with a third of all rows sends one pair of texts a task. If the two differ, the
hash collided, and the text itself becomes part of the key.

Defined cases: null text counts as empty; a null id never stays if its group has another id; rows repeated with the
same id and text get the same verdict; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, FILTER_KEYS, Filter, attach_groups, checked, holding, written


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id (smallest or greatest id of the equal texts), group_size, kept, text_sha256, text_hash.

    hash_of may be any function of the text; a weak one costs time, never rightness.
    """
    pick = {"min": F.min, "max": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit("")).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("__text"))
    hashed = source.withColumn("text_hash", hash_of(F.col("__text")))
    rows = written(hashed.select("doc_id", "text_hash", F.sha2("__text", 256).alias("text_sha256")), "exact-rows")
    groups = written(rows.groupBy("text_hash").agg(F.count(F.lit(1)).alias("group_size"), pick("doc_id").alias("keep_id")), "exact-groups")
    several = groups.where("group_size > 1").select("text_hash")
    compared = holding(hashed, several).groupBy("text_hash").agg(F.min("__text").alias("lo"), F.max("__text").alias("hi"))
    collided = written(compared.where("lo <> hi").select("text_hash"), "exact-collided")
    total = rows.count()
    if not collided.isEmpty():
        # The key is the hash and, where it collided, the text: hashed again with its length to stay narrow is not enough, so whole.
        few = checked(collided)
        texts = hashed.join(few, "text_hash", "left_semi")
        split = texts.groupBy("text_hash", "__text").agg(F.count(F.lit(1)).alias("group_size"), pick("doc_id").alias("keep_id"))
        odd = texts.withColumn("text_sha256", F.sha2("__text", 256)).join(split, ["text_hash", "__text"])
        plain = attach_groups(rows.join(few, "text_hash", "left_anti"), groups, "text_hash", "group_size", total)
        columns = ["doc_id", "keep_id", "group_size", "text_sha256", "text_hash"]
        out = plain.select(*columns).unionByName(odd.select(*columns))
    else:
        out = attach_groups(rows, groups, "text_hash", "group_size", total)
    kept = F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), "text_sha256", "text_hash")


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of gone (doc_id, text_hash), columns unchanged.

    gone is broadcast if it is small. Else only rows that pass a filter of gone, so few besides those that go, are
    shuffled and compared with it; beyond FILTER_KEYS rows all are.
    """
    gone = written(gone.select("doc_id", "text_hash").distinct(), "gone")
    n = gone.count()
    key = [F.col(f"d.{id_col}"), content_hash(F.coalesce(F.col(f"d.{text_col}"), F.lit("")).cast("string"))]

    def rest(rows: DataFrame, less: DataFrame) -> DataFrame:
        return rows.alias("d").join(less.alias("g"), key[0].eqNullSafe(F.col("g.doc_id")) & (key[1] == F.col("g.text_hash")), "left_anti")

    if n <= BROADCAST_ROWS or n > FILTER_KEYS:
        return rest(docs, F.broadcast(gone) if n <= BROADCAST_ROWS else gone)
    found = Filter(gone, n)
    flagged = found.joined(docs.alias("d"), key, "f")
    return flagged.where(~found.passes(key, "f")).select("d.*").union(rest(flagged.where(found.passes(key, "f")).select("d.*"), gone))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """docs without the rows whose text another row, which stays, has too; columns unchanged."""
    return without(docs, exact_groups(docs, id_col, text_col, keep).where("not kept"), id_col, text_col)
