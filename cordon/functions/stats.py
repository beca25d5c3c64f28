"""Correlation and least-squares line as plain aggregates.

Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column, so the
coefficient is assembled from ``covar_pop`` and ``stddev_pop`` over the pairs where
both values are present, with the zero-variance case mapped to null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pair(y: str, x: str) -> tuple[Column, Column]:
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    both = xd.isNotNull() & yd.isNotNull() & ~F.isnan(xd) & ~F.isnan(yd)
    xs = F.when(both, xd)
    ys = F.when(both, yd)
    return ys, xs


def guarded_corr(y: str, x: str) -> Column:
    """Pearson correlation over complete pairs; null for < 2 pairs or zero variance."""
    ys, xs = _pair(y, x)
    denom = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.covar_pop(xs, ys) / F.nullif(denom, F.lit(0.0))


def ols_fit(y: str, x: str) -> list[Column]:
    """Slope, intercept and r^2 of ``y = a + b x`` (what a fitted trendline reports)."""
    ys, xs = _pair(y, x)
    return [
        F.regr_slope(ys, xs).alias("slope"),
        F.regr_intercept(ys, xs).alias("intercept"),
        F.regr_r2(ys, xs).alias("r2"),
    ]
