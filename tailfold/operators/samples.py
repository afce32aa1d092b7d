"""Sample dimension: which samples take part, and how they are cut into blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shared_samples(phenotype_samples: DataFrame, *others: DataFrame) -> DataFrame:
    """Samples of the phenotype table that also occur in every other table."""
    out = phenotype_samples
    for other in others:
        out = out.join(other.select("sample_id"), "sample_id", "left_semi")
    return out


def overlap_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many samples are shared, only left, only right."""
    sides = left.select("sample_id", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select("sample_id", F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_sample = sides.groupBy("sample_id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return per_sample.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("shared_sample_count"),
        F.count_if(F.col("r") == 0).alias("left_only_sample_count"),
        F.count_if(F.col("l") == 0).alias("right_only_sample_count"),
    )


def design_table(shared: DataFrame, pcs: DataFrame, covariates: DataFrame | None,
                 max_pc: int) -> DataFrame:
    """``(sample_id, x)`` with the covariates first and then PC1..max_pc."""
    leading = F.slice("pcs", 1, max_pc) if max_pc else F.array().cast("array<double>")
    out = shared.select("sample_id").join(pcs.select("sample_id", "pcs"), "sample_id")
    if covariates is None:
        return out.select("sample_id", leading.alias("x"))
    out = out.join(covariates.select("sample_id", "covs"), "sample_id")
    return out.select("sample_id", F.concat("covs", leading).alias("x"))


def block_samples(design: DataFrame, blocks: int, runs: int = 1) -> DataFrame:
    """Give every sample a block ``sb`` and a row number ``pos`` of its own in it.

    Blocks come from a hash and are numbered in ``runs``, so numbering never sorts all
    samples in one task.  Numbers are dense with one run.
    """
    run = F.pmod(F.xxhash64("sample_id"), F.lit(blocks * runs)).cast("int")
    hashed = design.withColumn("_run", run)
    order = Window.partitionBy("_run").orderBy("sample_id")
    at = (F.row_number().over(order) - 1) * runs + F.floor(F.col("_run") / blocks)
    return hashed.withColumn("pos", at.cast("int")).withColumn("sb", F.pmod("_run", F.lit(blocks)).cast("int")).drop("_run")
