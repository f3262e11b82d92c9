"""Mixing sources to target weights by Pfair scheduling.

A source's rows are cut into blocks. Of a source whose weight is the share w of all, block i (from 1) may not start
before slot floor((i - 1) / w) and must be done by slot ceil(i / w); earliest deadline first among the released blocks
then keeps every source within less than one block of its share at every slot. Weights are exact fractions, taken as
written in decimal; in whole numbers of the same proportions the schedule repeats after their sum. So the driver plans
one period, or less where a source runs out before, whatever the number of rows; rows take their slots by joins with
the plan. When a source runs out, the others go on with their weights to each other, as a new phase with a period of
its own; there are at most as many phases as sources, and no row is dropped. The plans of all phases may have MAX_PLAN
slots together (and at most as many as there are blocks); weights or numbers of sources that need more are refused.

Rows of a source are taken in the order of a hash of their ids.

Defined cases: a null source is a source of its own; sources without a target weight get `other`; an empty table gives
an empty result; repeated rows each take a place; null ids and texts are placed too; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rank_within, written

#: Steps of the plans of all phases: slots, and sources of each phase.
MAX_PLAN = 3_000_000


def period(weights: dict[str, int]) -> Iterator[tuple[int, str]]:
    """(slot, source) of one period under earliest deadline first; sum(weights) slots, weights[s] of them for s."""
    q = sum(weights.values())
    waiting: list[tuple[int, str, int]] = []  # (release, source, block)
    ready: list[tuple[int, int, str, int]] = []  # (deadline, next block's release, source, block)
    for s in sorted(weights):
        heapq.heappush(waiting, (0, s, 1))
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-i * q // weights[s]), i * q // weights[s], s, i))
        _, release, s, i = heapq.heappop(ready)
        yield slot, s
        if i < weights[s]:
            heapq.heappush(waiting, (max(release, slot + 1), s, i + 1))


@dataclass(frozen=True)
class Part:
    """A source's blocks first up to end (from 0, its own count) in a phase: block first + j lies in slot
    start + j // weight * period + at[j % weight]."""

    source: str
    first: int
    end: int
    weight: int
    start: int
    period: int
    at: list[int]


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[Part]:
    """The plan for sources with so many blocks, a source's parts in their order."""
    done = dict.fromkeys(blocks, 0)
    active = sorted(s for s in blocks if blocks[s])
    start, planned, out = 0, 0, []
    while active:
        common = gcd(*(weights[s] for s in active))
        own = {s: weights[s] // common for s in active}
        q, slots = sum(own.values()), {s: [] for s in active}
        planned += len(active)
        for slot, s in period(own):
            slots[s].append(slot)
            planned += 1
            if planned > MAX_PLAN:
                raise ValueError(f"weights of {len(blocks)} sources need a plan of more than {MAX_PLAN} steps")
            if len(slots[s]) == blocks[s] - done[s]:  # it runs out within the first period
                end = slot + 1
                break
        else:
            # The phase ends after the slot of the first source's last block.
            last = {s: blocks[s] - done[s] - 1 for s in active}
            end = min(j // own[s] * q + slots[s][j % own[s]] for s, j in last.items()) + 1
        for s in active:
            n = end // q * own[s] + bisect_left(slots[s], end % q) if end >= q else len(slots[s])
            if n:
                out.append(Part(s, done[s], done[s] + n, own[s], start, q, slots[s][:n]))
            done[s] += n
        start += end
        active = [s for s in active if done[s] < blocks[s]]
    return out


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the given proportions; floats count as their shortest decimal."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    common = lcm(*(f.denominator for f in exact.values()))
    return {s: int(f * common) for s, f in exact.items()}


def _placed(rows: DataFrame, weights: dict[str, float] | None, other: float, block_rows: int) -> DataFrame:
    """rows (doc_id, source and any others) with block, slot and position."""
    spark = rows.sparkSession
    found = rows.groupBy("source").count().limit(MAX_PLAN + 1).collect()  # a source takes a slot of the plan at least
    if len(found) > MAX_PLAN:
        raise ValueError(f"more than {MAX_PLAN} sources")
    ranked = rank_within(rows, ["source"], ["doc_id"]).withColumn("block", F.floor(F.col("rank") / block_rows).cast("long"))
    # Names are prefixed, so that a null source and one named like a missing value stay apart.
    key = {("?" if r[0] is None else "=" + r[0]): r[0] for r in found}
    given = weights or {}
    plan = phases({k: -(-r[1] // block_rows) for k, r in zip(key, found)}, whole_weights({k: given.get(s, other) for k, s in key.items()}))
    # Two tables of at most MAX_PLAN rows: the parts of each source, and the slots of each part.
    parts: dict[str, list[tuple]] = {}
    for i, p in enumerate(plan):
        parts.setdefault(p.source, []).append((i, p.first, p.weight, p.start, p.period))
    of = spark.createDataFrame([(key[s], own) for s, own in parts.items()], "of_source string, parts array<struct<part:int,first:long,weight:long,start:long,period:long>>")
    slots = spark.createDataFrame([(i, j, at) for i, p in enumerate(plan) for j, at in enumerate(p.at)], "of_part int, k long, at long")
    out = ranked.join(F.broadcast(of), F.col("source").eqNullSafe(F.col("of_source")))
    out = out.withColumn("part", F.element_at(F.filter("parts", lambda p: p["first"] <= F.col("block")), -1)).withColumn("j", F.col("block") - F.col("part.first"))
    out = out.join(F.broadcast(slots), (F.col("part.part") == F.col("of_part")) & (F.pmod("j", F.col("part.weight")) == F.col("k")))
    slot = F.col("part.start") + F.floor(F.col("j") / F.col("part.weight")) * F.col("part.period") + F.col("at")
    out = out.withColumn("slot", slot.cast("long")).withColumn("position", (slot * block_rows + F.col("rank") % block_rows).cast("long"))
    return out.drop("of_source", "parts", "part", "j", "of_part", "k", "at")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, other: float = 1.0, block_rows: int = 16, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, source, block (of its source, from 0), slot (of the block in the mixture,
    from 0, gapless) and position (of the row in the mixture; ordered by slot, gapless within a block)."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source")), "mix-rows")
    return _placed(rows, weights, other, block_rows).select("doc_id", "source", "block", "slot", "position")


def mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, other: float = 1.0, block_rows: int = 16, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with the same rows and columns, laid out in the order of the mixture: written files and the rows in them follow it."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.struct(*docs.columns).alias("row"))
    placed = _placed(rows, weights, other, block_rows).select("position", "row")
    return placed.repartitionByRange("position").sortWithinPartitions("position").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
