"""2x2-table statistics: ratios as columns, Fisher's exact test as a pandas UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Terms further than this below the mode do not change a double.
UNDERFLOW = -800.0
# fixed value: tables this close in probability to the observed one count as ties
TIE_TOLERANCE = np.log1p(1e-12)
STEP = 1 << 15


def _walk(first_ratio, count: int):
    """Log probabilities relative to the mode, in blocks, moving away from it.

    ``first_ratio(i)`` gives log P(i+1 steps)/P(i steps) for an index array.
    """
    level = np.longdouble(0)
    for lo in range(0, count, STEP):
        steps = np.arange(lo, min(lo + STEP, count), dtype=np.longdouble)
        block = level + np.cumsum(first_ratio(steps))
        yield block
        level = block[-1]
        if level < UNDERFLOW:
            return


def fisher_two_sided(n11: int, n10: int, n01: int, n00: int) -> float:
    """Two-sided Fisher exact p-value of one table.

    The hypergeometric distribution is walked outwards from its mode in numpy
    blocks of extended precision, so billion-scale margins neither lose digits
    (as differences of log-gamma would) nor hold the support in memory.
    """
    cells = (n11, n10, n01, n00)
    if any(isinstance(c, bool) or int(c) != c or c < 0 for c in cells):
        raise ValueError("table cells must be non-negative integers")
    n11, n10, n01, n00 = map(int, cells)
    row, col, total = n11 + n10, n11 + n01, n11 + n10 + n01 + n00
    low, high = max(0, row + col - total), min(row, col)
    if low == high:
        return 1.0
    mode = min(max((row + 1) * (col + 1) // (total + 2), low), high)
    rest = total - row - col

    def down(i):
        x = mode - i
        return np.log(x) + np.log(rest + x) - np.log(col - x + 1) - np.log(row - x + 1)

    def up(i):
        x = mode + i
        return np.log(col - x) + np.log(row - x) - np.log(x + 1) - np.log(rest + x + 1)

    side, away = (down, mode - n11) if n11 < mode else (up, n11 - mode)
    observed = np.longdouble(0)
    for block in _walk(side, away):
        observed = block[-1]
    limit = observed + TIE_TOLERANCE
    if limit >= 0:
        return 1.0
    whole, tail = np.longdouble(1), np.longdouble(0)
    for step, count in ((down, mode - low), (up, high - mode)):
        for block in _walk(step, count):
            p = np.exp(block)
            whole += p.sum()
            tail += p[block <= limit].sum()
    return float(min(1.0, max(0.0, tail / whole)))


@F.pandas_udf(T.DoubleType())
def fisher_exact(n11: pd.Series, n10: pd.Series, n01: pd.Series, n00: pd.Series) -> pd.Series:
    """Arrow-batched Fisher test; repeated tables in a batch are computed once."""
    tables = pd.DataFrame({"a": n11, "b": n10, "c": n01, "d": n00})
    distinct = tables.drop_duplicates().dropna()
    p = {t: fisher_two_sided(*map(int, t)) for t in distinct.itertuples(index=False, name=None)}
    return pd.Series([p.get(t, np.nan) for t in tables.itertuples(index=False, name=None)])


def register(spark: SparkSession) -> None:
    """Make ``fisher_exact(n11, n10, n01, n00)`` callable from Spark SQL."""
    spark.udf.register("fisher_exact", fisher_exact)


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def table_statistics(outlier_carriers: Column, outliers: Column,
                     other_carriers: Column, others: Column) -> dict[str, Column]:
    """Rates and odds ratios from carrier counts and group sizes.

    Products are formed as doubles: at billions of observations the integer
    product of two cells does not fit a long.
    """
    def half(c: Column) -> Column:
        return c.cast("double") + 0.5

    outlier_rest, other_rest = outliers - outlier_carriers, others - other_carriers
    outlier_rate = ratio(outlier_carriers, outliers)
    other_rate = ratio(other_carriers, others)
    a, b = outlier_carriers.cast("double"), outlier_rest.cast("double")
    c, d = other_carriers.cast("double"), other_rest.cast("double")
    return {
        "outlier_carrier_rate": outlier_rate,
        "nonoutlier_carrier_rate": other_rate,
        "carrier_rate_ratio": F.try_divide(outlier_rate, other_rate),
        "odds_ratio": F.try_divide(a * d, c * b),
        "odds_ratio_corrected_0_5": (half(outlier_carriers) * half(other_rest))
        / (half(other_carriers) * half(outlier_rest)),
    }
