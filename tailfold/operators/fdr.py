"""Benjamini-Hochberg adjustment over all rows of a table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailfold.operators.ordered import running
from tailfold.session import stage

ROWS_PER_BUCKET = 1_000_000
# Distinct p-values with their results that may be broadcast, some 50 MB as a hash table.
BROADCAST_VALUES = 1_000_000
# When the values are too many to broadcast, the rows of a value held by so many are dealt into parts.
HEAVY_ROWS = 100_000
SALTS = 32


def _cuts(distinct: DataFrame, p: str, values: int) -> list[float]:
    """Approximate quantiles of the distinct p-values: one bucket per ROWS_PER_BUCKET."""
    buckets = math.ceil(values / ROWS_PER_BUCKET)
    if buckets <= 1:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = distinct.agg(F.percentile_approx(p, shares, 10_000).alias("cuts")).first().cuts
    return sorted(set(found or []))


def benjamini_hochberg(df: DataFrame, p: str = "fisher_p_value",
                       out: str = "fisher_fdr_bh", small: bool = False) -> DataFrame:
    """Add ``out``: the smallest ``p' * n / rank(p')`` over all p' >= p, at most 1.

    Equal p-values share their rank's last position, so counting rows per distinct
    p-value first is exact and takes care of a value held by very many rows.  The
    counted values are staged once; running sums and minima then go over quantile
    buckets of them.  ``small`` is for tables bounded by parameters, such as a result
    grid: one window, no staging.
    """
    if small:
        return _windowed(df, p, out, F.lit(1))
    counted = df.where(F.col(p).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("_rows"))
    distinct = stage(counted, "p-values")
    found = distinct.agg(F.count(F.lit(1)).alias("values"), F.count_if(F.col("_rows") >= HEAVY_ROWS).alias("heavy")).first()
    values = found["values"]
    cuts = _cuts(distinct, p, values)
    if cuts:
        total = distinct.agg(F.sum("_rows").alias("_n")).scalar()
        final = _bucketed(distinct, p, total, cuts).select(p, "_rows", _clamped("_q").alias(out))
    else:
        final = _windowed(distinct, p, out, F.col("_rows")).select(p, "_rows", out)
    if values <= BROADCAST_VALUES:
        return df.join(F.broadcast(final.drop("_rows")), p, "left")
    dealt, results = _dealt(df, distinct, final, p, found["heavy"])
    return dealt.join(results, [p, "_salt"], "left").drop("_salt")


def _dealt(df: DataFrame, distinct: DataFrame, final: DataFrame, p: str, heavy: int):
    """Rows and results with ``_salt``: p = 1 may hold a large share of the rows, so rows of heavy
    values, and those without a value, are dealt, and only the results of heavy values repeated."""
    part = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    many = F.col(p).isNull()
    if heavy:
        marked = distinct.where(F.col("_rows") >= HEAVY_ROWS).select(p, F.lit(True).alias("_heavy"))
        df = df.join(F.broadcast(marked), p, "left")
        many = many | F.col("_heavy").isNotNull()
    dealt = df.withColumn("_salt", F.when(many, part).otherwise(0)).drop("_heavy")
    copies = F.when(F.col("_rows") >= HEAVY_ROWS, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt, final.withColumn("_salt", F.explode(copies)).drop("_rows")


def _clamped(c) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def _windowed(df: DataFrame, p: str, out: str, weight: Column) -> DataFrame:
    """One window over a small table: range frames take equal p-values as one."""
    edge, end = Window.unboundedPreceding, Window.unboundedFollowing
    rows = F.when(F.col(p).isNotNull(), weight)
    rank = F.sum(rows).over(Window.orderBy(F.asc(p)).rangeBetween(edge, 0))
    total = F.sum(rows).over(Window.orderBy(F.asc(p)).rangeBetween(edge, end))
    beyond = Window.orderBy(F.desc(p)).rangeBetween(edge, 0)
    return df.withColumn("_scaled", F.col(p) * total / rank).withColumn(
        out, _clamped(F.min("_scaled").over(beyond))).drop("_scaled")


def _bucketed(distinct: DataFrame, p: str, total: Column, cuts: list[float]) -> DataFrame:
    """The two running aggregates over quantile buckets of the distinct p-values."""
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<double>")
    above = F.filter(edges, lambda c: c < F.col(p))
    ranked = running(
        distinct.withColumn("_bucket", F.size(above)), [], "_bucket", F.asc(p),
        F.asc("_bucket"), "_rows", "sum", "_rank",
    )
    scaled = ranked.withColumn("_scaled", F.col(p) * total / F.col("_rank"))
    return running(scaled, [], "_bucket", F.desc(p), F.desc("_bucket"), "_scaled", "min", "_q")
