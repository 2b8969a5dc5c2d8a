"""Aggregates that stay defined on constant or empty groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null if a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def root_mean_square(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def describe_columns(c: Column) -> list[Column]:
    """Moments of a describe table; quartiles come from ``exact_quantiles``."""
    return [
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ]
