"""Choosing a PC count: median log odds ratio, plateau rule, percent of maximum."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailfold import config, vocab


def _estimable() -> Column:
    ratio = F.col("odds_ratio")
    return (ratio > 0) & (ratio < F.lit(float("inf")))


def selection_rows(results: DataFrame, thresholds, definitions) -> DataFrame:
    wanted = config.negative_thresholds(thresholds)
    return results.where(
        F.col("z_threshold").isin(*wanted) & F.col("carrier_definition").isin(*definitions)
    )


def median_log_odds(results: DataFrame, thresholds=vocab.SELECTION_THRESHOLDS,
                    definitions=vocab.SELECTION_DEFINITIONS) -> DataFrame:
    """Median log odds ratio per PC count and definition, complete groups only.

    A group holds one row per threshold, so the exact median never sees more
    values than there are thresholds.
    """
    rows = selection_rows(results, thresholds, definitions).where(_estimable())
    grouped = rows.groupBy("pc_count", "carrier_definition").agg(
        F.count_distinct("z_threshold").alias("_seen"),
        F.median(F.log("odds_ratio")).alias("median_log_odds_ratio"),
    )
    complete = grouped.where(F.col("_seen") == len(set(thresholds))).drop("_seen")
    return complete.withColumn("median_odds_ratio", F.exp("median_log_odds_ratio"))


def plateau_entry(points: DataFrame, fraction: float = vocab.PLATEAU_FRACTION) -> DataFrame:
    """Per definition: maximum, plateau threshold and the first count reaching it."""
    config.plateau_fraction(fraction)
    top = points.groupBy("carrier_definition").agg(
        F.max("median_log_odds_ratio").alias("max_median_log_odds_ratio"))
    level = F.col("max_median_log_odds_ratio") + F.lit(math.log(fraction))
    joined = points.join(top, "carrier_definition").withColumn("plateau_log_odds_ratio", level)
    reached = F.col("median_log_odds_ratio") >= F.col("plateau_log_odds_ratio")
    return joined.groupBy(
        "carrier_definition", "max_median_log_odds_ratio", "plateau_log_odds_ratio"
    ).agg(F.min(F.when(reached, F.col("pc_count"))).alias("minimum_pc_count"))


def sweep_groups(results: DataFrame, thresholds=vocab.SELECTION_THRESHOLDS,
                 definitions=vocab.SELECTION_DEFINITIONS) -> DataFrame:
    """Sweep summary before the maximum is known; may hold incomplete groups."""
    rows = selection_rows(results, thresholds, definitions).where(_estimable())
    present = F.sort_array(F.collect_set("z_threshold"), asc=False)
    return rows.groupBy("carrier_definition", "pc_count").agg(
        F.count_distinct("z_threshold").alias("n_thresholds"),
        present.alias("_present"),
        F.median(F.log("odds_ratio")).alias("median_log_odds_ratio"),
    ).select(
        "carrier_definition", "pc_count", "n_thresholds",
        F.array_join(F.transform("_present", threshold_text), ",").alias("thresholds_present"),
        "median_log_odds_ratio", F.exp("median_log_odds_ratio").alias("median_odds_ratio"),
    )


def threshold_text(value: Column) -> Column:
    """Shortest text of a threshold: -3.0 prints as -3."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def percent_of_maximum(groups: DataFrame) -> DataFrame:
    """Relate every group to its definition's best one (ties: fewest PCs)."""
    best = Window.partitionBy("carrier_definition").orderBy(
        F.desc("median_odds_ratio"), F.asc("pc_count"))
    top = (
        groups.withColumn("_place", F.row_number().over(best)).where("_place = 1")
        .select("carrier_definition", F.col("pc_count").alias("maximum_pc"),
                F.col("median_odds_ratio").alias("maximum_median_odds_ratio"))
    )
    share = 100 * F.col("median_odds_ratio") / F.col("maximum_median_odds_ratio")
    return groups.join(top, "carrier_definition").withColumn("percent_of_maximum", share).select(
        *vocab.SWEEP_COLUMNS)
