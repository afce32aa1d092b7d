"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step; ``edges`` holds each link once, as (u, v) with u > v.

    Large star: every node links its larger neighbours to the smallest of its neighbourhood.
    Small star: every node links its smaller neighbours, and itself, to the smallest of them.
    """
    if large:
        links = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = (links.join(least, "u").where(F.col("v") > F.col("u"))
               .select(F.col("v").alias("u"), F.col("m").alias("v")))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").where(F.col("v") != F.col("m"))
        out = (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node of the component) of every node that has a link.

    ``edges`` has long columns ``u`` and ``v`` in any order.  Every step is written to the shared
    staging folder; the number of steps grows with the logarithm of the longest path.
    """
    current = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where(F.col("u") != F.col("v")).distinct(), "links")
    seen = None
    while True:
        current = stage(_star(_star(current, True), False), "stars")
        state = tuple(current.agg(F.count(F.lit(1)), F.sum("v"), F.sum("u"),
                                  F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == seen:
            break
        seen = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v"), F.col("v")).distinct())
