"""Interleaving sources at target weights by Pfair scheduling (built-in SQL functions only).

Every source is a lane with an integer number of parts; its documents are put into a repeatable
random order and cut into blocks.  With weight ``w = parts / all parts``, block ``j`` of a lane may
run from slot ``floor(j / w)`` and must have run by slot ``ceil((j + 1) / w)``.  Taking the released
block with the earliest deadline in each slot keeps every lane within less than one block of its
target at every slot.  Because the parts are integers, that schedule repeats after ``sum(parts)``
slots: one period is worked out when the plan is made (its size depends on the weights only), and
all blocks find their slots by arithmetic, in parallel.

When a lane has run out, the others share its slots in proportion to their parts, counted anew from
that slot on; no document is dropped or repeated.

Defined results: sources without a weight, null ones included, share the lane named ``None``; rows
without an id are ordered after the others of their bucket; extra columns stay, whatever they are
called, except that ``schedule`` puts its own ``lane``, ``block``, ``slot`` and ``position`` in place of
columns of these names; repeated rows have a place each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import gcd
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Documents of one (lane, bucket), which are ordered by one task.
BUCKET_ROWS = 20_000


@dataclass(frozen=True)
class Run:
    """Blocks ``first .. first + blocks - 1`` of a lane within one phase of the schedule."""

    lane: int
    first: int
    blocks: int
    start_slot: int
    period: int
    offsets: tuple[int, ...]


def period_schedule(parts: list[int]) -> list[int]:
    """The lane of each slot of one period, earliest deadline first."""
    shrink = reduce(gcd, parts)
    parts = [p // shrink for p in parts]
    period, done, slots = sum(parts), [0] * len(parts), []
    for slot in range(period):
        _, lane = min(
            (-(-(done[i] + 1) * period // p), i)
            for i, p in enumerate(parts) if done[i] < p and done[i] * period // p <= slot)
        done[lane] += 1
        slots.append(lane)
    return slots


def plan_runs(parts: list[int], blocks: list[int]) -> list[Run]:
    """Phases until every lane is used up; at most one per lane."""
    used, slot, runs = [0] * len(parts), 0, []
    while active := [i for i, n in enumerate(blocks) if used[i] < n]:
        slots = period_schedule([parts[i] for i in active])
        period = len(slots)
        offsets = {lane: tuple(t for t, s in enumerate(slots) if s == k)
                   for k, lane in enumerate(active)}

        def last_slot(lane: int, offsets=offsets, period=period) -> int:
            own, left = offsets[lane], blocks[lane] - used[lane] - 1
            return left // len(own) * period + own[left % len(own)]

        length = min(map(last_slot, active)) + 1
        for lane in active:
            own = offsets[lane]
            ran = length // period * len(own) + sum(t < length % period for t in own)
            if ran:
                runs.append(Run(lane, used[lane], ran, slot, period, own))
            used[lane] += ran
        slot += length
    return runs


def _lane(source: Column, names: list[str]) -> Column:
    lane = F.lit(len(names))
    for i, name in enumerate(names):
        lane = F.when(source == name, F.lit(i)).otherwise(lane)
    return lane


def _run_table(spark, runs: list[Run]) -> DataFrame:
    rows = ", ".join(
        f"({r.lane}, {r.first}L, {r.blocks}L, {r.start_slot}L, {r.period}L,"
        f" array({', '.join(map(str, r.offsets))}))" for r in runs)
    names = "_lane, _first, _blocks, _start, _period, _offsets"
    if not runs:
        rows = "(0, 0L, 0L, 0L, 1L, array(0))"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS runs({names})")


def schedule(docs: DataFrame, parts: dict[str, int], rest_parts: int, block_docs: int,
             seed: int = 0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with ``lane``, ``block``, ``slot`` and the dense ``position`` in the mixture.

    Two passes over id and source (counts), one shuffle of the given columns.
    """
    own = ("lane", "block", "slot", "position")
    placed = _placed(docs, parts, rest_parts, block_docs, seed, id_col, source_col)
    return placed.select(
        *[F.col("doc")[c].alias(c) for c in docs.columns if c not in own], *own)


def _placed(docs: DataFrame, parts: dict[str, int], rest_parts: int, block_docs: int, seed: int,
            id_col: str, source_col: str) -> DataFrame:
    """``doc`` (a row as a struct), ``lane``, ``block``, ``slot`` and ``position``."""
    docs = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"))
    id_col, source_col = "id", "source"
    names = list(parts)
    lane_parts = [*parts.values(), rest_parts]
    if min(lane_parts) < 1 or block_docs < 1:
        raise ValueError("parts and block_docs are positive integers")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    light = docs.select(_lane(F.col(source_col), names).alias("_lane"), key.alias("_key"))
    total = docs.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    bucket = F.floor(
        F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2 ** 32))
    sizes = light.groupBy("_lane", bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.withColumn("_before", F.sum("_size").over(
        Window.partitionBy("_lane").orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size"))
    totals = {r["_lane"]: r["n"] for r in
              light.groupBy("_lane").agg(F.count(F.lit(1)).alias("n")).collect()}
    lane_docs = [totals.get(i, 0) for i in range(len(lane_parts))]
    runs = plan_runs(lane_parts, [-(-n // block_docs) for n in lane_docs])

    # A last block that is not full moves everything after it forward.
    short = []
    for lane, n in enumerate(lane_docs):
        if n % block_docs:
            run = max((r for r in runs if r.lane == lane), key=lambda r: r.first)
            j = run.blocks - 1
            last = (run.start_slot + j // len(run.offsets) * run.period
                    + run.offsets[j % len(run.offsets)])
            short.append(F.when(F.col("slot") > last, block_docs - n % block_docs).otherwise(0))
    lost = reduce(add, short) if short else F.lit(0)

    order = Window.partitionBy("_lane", "_bucket").orderBy(
        "_key", F.col(id_col).asc_nulls_last())
    j = F.col("block") - F.col("_first")
    own = F.size("_offsets")
    return (
        docs.withColumn("_lane", _lane(F.col(source_col), names)).withColumn("_key", key)
        .withColumn("_bucket", bucket)
        .withColumn("_rank", F.row_number().over(order))
        .join(starts.drop("_size"), ["_lane", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_rank") - 1)
        .withColumn("block", F.floor(F.col("_rank") / block_docs))
        .join(F.broadcast(_run_table(docs.sparkSession, runs)).withColumnRenamed("_lane", "_of"),
              (F.col("_lane") == F.col("_of")) & (F.col("block") >= F.col("_first"))
              & (F.col("block") < F.col("_first") + F.col("_blocks")))
        .withColumn("slot", F.col("_start") + F.floor(j / own) * F.col("_period")
                    + F.element_at("_offsets", (j % own + 1).cast("int")))
        .withColumn("position", F.col("slot") * block_docs + F.col("_rank") % block_docs - lost)
        .select("doc", F.element_at(F.array(*[F.lit(n).cast("string") for n in [*names, None]]),
                                    F.col("_lane") + 1).alias("lane"),
                "block", "slot", F.col("position").cast("long").alias("position")))


def mixed(docs: DataFrame, parts: dict[str, int], rest_parts: int, block_docs: int,
          seed: int = 0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs``, all rows and columns, in the order of the mixture (also across part files)."""
    return (
        _placed(docs, parts, rest_parts, block_docs, seed, id_col, source_col)
        .repartitionByRange("position").sortWithinPartitions("position")
        .select("doc.*"))
