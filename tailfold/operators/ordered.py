"""Running aggregates over a total order, without sorting a key in one task.

A plain window puts all rows of a partition key into one task.  Here the order is
cut into buckets: the window runs inside each bucket, bucket totals run over the
few buckets, and both are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
}


def running(df: DataFrame, keys: list[str], bucket: str, order: Column, bucket_order: Column,
            value: str, kind: str, out: str, inclusive: bool = True) -> DataFrame:
    """Add ``out``: the ``kind`` of ``value`` over all earlier rows of ``keys``.

    ``bucket`` must be monotone in ``order`` within ``keys``; ``greatest`` and
    ``least`` skip NULLs, so the first row of a key gets NULL (0 for sums) when the
    current row does not count.
    """
    aggregate, combine = _COMBINE[kind]
    local = (
        Window.partitionBy(*keys, bucket).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    across = (
        Window.partitionBy(*keys).orderBy(bucket_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = (
        df.groupBy(*keys, bucket).agg(aggregate(value).alias("_total"))
        .withColumn("_before", aggregate("_total").over(across)).drop("_total")
    )
    joined = df.withColumn("_local", aggregate(value).over(local)).join(
        totals, [*keys, bucket])
    return joined.withColumn(out, combine(F.col("_before"), F.col("_local"))).drop(
        "_before", "_local")
