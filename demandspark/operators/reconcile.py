"""Forecasts of a hierarchy made to add up, by one sweep up and one down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.staging import staged

# Least variance taken seriously; a forecast without spread would leave its level no say.
LEAST_VARIANCE = 1e-12


def reconcile(
    levels: Sequence[DataFrame], keys: Sequence[Sequence[str]], at: Sequence[str], value: str = "value", variance: str = "variance"
) -> DataFrame:
    """Weighted least squares over a tree: the closest forecasts, by inverse variance, that add up.

    ``levels`` run from the lowest to the highest; ``keys[i]`` names a node of level i, and the
    keys of a level are among those of the level below. ``at`` are further columns that a
    forecast is for (origin, target date).

    Up: a node weighs its own forecast against the sum of its children's, each by its
    precision. Down: what a node's final value exceeds its children's sum by is dealt to the
    children by their variances. Sums combine map-side, so a parent of a third of all series
    is no single task; the sweeps are one aggregate and one join a level.

    The result has ``level``, the keys (null above their level), ``at``, ``value`` and
    ``reconciled``. A node without a forecast of its own (no row, null, or no variance) takes
    its children's sum; a lowest node without one is left out of the sums and stays null, and a
    node with neither is null as well. A child whose parent has no row has a parent made for it.
    """
    up: list[DataFrame] = []
    for i, base in enumerate(levels):
        names = [*keys[i], *at]
        own = base.select(
            *names, F.col(value).cast("double").alias("value"),
            F.when(F.col(value).isNotNull(), 1.0 / F.greatest(F.col(variance).cast("double"), F.lit(LEAST_VARIANCE))).alias("w"),
        )
        if i == 0:
            made = own.select(*names, "value", F.when(F.col("w").isNotNull(), F.col("value")).alias("m"), (1.0 / F.col("w")).alias("v"))
        else:
            below = up[-1].where("m is not null").groupBy(*names).agg(F.sum("m").alias("sum_m"), F.sum("v").alias("sum_v"))
            both = _join(own, below, names, "full")
            w, wc = F.coalesce("w", F.lit(0.0)), F.coalesce(1.0 / F.col("sum_v"), F.lit(0.0))
            total = w + wc
            mean = (F.coalesce(F.col("value") * w, F.lit(0.0)) + F.coalesce(F.col("sum_m") * wc, F.lit(0.0))) / total
            made = both.select(
                *names, "value", F.when(total > 0, mean).alias("m"), F.when(total > 0, 1.0 / total).alias("v"), "sum_m", "sum_v"
            )
        up.append(staged(made, "level-up"))
    found = [up[-1].withColumn("reconciled", F.col("m"))]
    for i in range(len(levels) - 2, -1, -1):
        names = [*keys[i + 1], *at]
        above = staged(found[-1], "level-down")
        found[-1] = above
        parent = above.select(*names, ((F.col("reconciled") - F.col("sum_m")) / F.col("sum_v")).alias("share"))
        down = _join(up[i], parent, names, "left")
        found.append(down.withColumn("reconciled", F.col("m") + F.col("v") * F.col("share")).drop("share"))
    every = list(dict.fromkeys(k for level in keys for k in level))
    frames = [
        df.select(
            F.lit(len(levels) - 1 - i).alias("level"),
            *[F.col(k) if k in keys[len(levels) - 1 - i] else F.lit(None).cast(levels[0].schema[k].dataType).alias(k) for k in every],
            *at, "value", "reconciled",
        )
        for i, df in enumerate(found)
    ]
    return reduce(DataFrame.unionByName, frames)


def _join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys meet as well."""
    renamed = right.withColumnsRenamed({n: f"_{n}" for n in names})
    joined = left.join(renamed, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]), how)
    if how == "full":
        joined = joined.withColumns({n: F.coalesce(n, f"_{n}") for n in names})
    return joined.drop(*[f"_{n}" for n in names])
