"""Sums that do not depend on the order of the rows, and what is made from them.

A sum of doubles depends on how the rows fall into partitions, in its last bits.  A value cast to a decimal of
fixed scale is a whole number of units, and sums of those are exact in any order; only the last step, from the sum
to a double, rounds.  Values keep 12 digits behind the point, and up to 10^26 in all before it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 12
UNITS = f"decimal(38,{SCALE})"


def units(value: Column) -> Column:
    """The value in units of the scale; null where it is null or not finite."""
    x = value.cast("double")
    return F.when(F.abs(x) < float("inf"), x).cast(UNITS)


def exact_sum(value: Column) -> Column:
    """Sum of the non-null values as a double; NaN if one of them is not finite, null if there is none."""
    x = value.cast("double")
    odd = F.count_if(x.isNotNull() & ~F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(odd > 0, F.lit(float("nan"))).otherwise(F.sum(units(value)).cast("double"))


def exact_avg(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def _moments(y: Column, x: Column) -> tuple[Column, ...]:
    """``n, sxx, syy, sxy``: count and centred second moments of the pairs of which both are finite.

    Every sum in them is exact, so they are the same doubles for any order of the rows.
    """
    both = units(x).isNotNull() & units(y).isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    n = F.count(a)

    def centred(p: Column, q: Column) -> Column:
        return exact_sum(p * q) - exact_sum(p) * exact_sum(q) / F.nullif(n, F.lit(0))

    return n, centred(a, a), centred(b, b), centred(a, b)


def exact_corr(y: str, x: str) -> Column:
    """Pearson correlation over complete pairs; null for fewer than two or no variance."""
    _, sxx, syy, sxy = _moments(F.col(y), F.col(x))
    return sxy / F.nullif(F.sqrt(F.greatest(sxx, F.lit(0.0)) * F.greatest(syy, F.lit(0.0))), F.lit(0.0))


def exact_ols(y: str, x: str) -> list[Column]:
    """Slope and intercept of ``y = a + b x`` and r²; null where they are not defined."""
    n, sxx, syy, sxy = _moments(F.col(y), F.col(x))
    slope = sxy / F.nullif(sxx, F.lit(0.0))
    both = units(F.col(x)).isNotNull() & units(F.col(y)).isNotNull()
    mean = lambda c: exact_sum(F.when(both, F.col(c))) / F.nullif(n, F.lit(0))
    r2 = sxy * sxy / F.nullif(sxx * syy, F.lit(0.0))
    return [slope.alias("slope"), (mean(y) - slope * mean(x)).alias("intercept"), r2.alias("r2")]
