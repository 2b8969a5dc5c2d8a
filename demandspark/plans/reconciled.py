"""Forecasts of products, branches and countries that add up."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.forecasters import Forecaster, backtest
from demandspark.operators.grid import latest_origin
from demandspark.operators.reconcile import reconcile
from demandspark.spec import BRANCH, COUNTRY, CURRENCY, DATE, DEMAND, PRODUCT, TARGET_DATE, ForecastSpec
from demandspark.staging import staged

LEVELS = ((PRODUCT, BRANCH, COUNTRY, CURRENCY), (BRANCH, COUNTRY, CURRENCY), (COUNTRY, CURRENCY))


def reconciled_forecast(
    history: DataFrame, make: Callable[[ForecastSpec], Forecaster], spec: ForecastSpec = ForecastSpec(),
    levels: Sequence[Sequence[str]] = LEVELS, origins: DataFrame | None = None,
) -> DataFrame:
    """Every level forecast on its own summed history, then reconciled.

    ``make`` gives the forecaster of a spec, which is asked for the series of each level.
    The middle quantile is reconciled with the variance that the outer quantiles have under a
    normal band, and the outer quantiles move with it. Origins default to the last date of
    each country. Columns: ``level`` (0 is the lowest), keys (null above their level), origin, target
    date, ``value`` (the level's own middle quantile), and the quantiles.
    """
    q = spec.quantiles
    history = staged(history, "history")
    origins = staged(latest_origin(history) if origins is None else origins, "reconciled-origins")
    low, high = q.probabilities[0], q.probabilities[-1]
    width = NormalDist().inv_cdf(high) - NormalDist().inv_cdf(low)
    base = []
    for keys in levels:
        summed = history.groupBy(*keys, DATE).agg(F.sum(DEMAND).alias(DEMAND))
        scored = backtest(staged(summed, "level-history"), make(replace(spec, keys=tuple(keys))), origins)
        spread = (F.col(q.high) - F.col(q.low)) / width
        base.append(staged(scored.withColumns({"value": F.col(q.mid), "variance": spread * spread}), "level-forecast"))
    at = [DATE, TARGET_DATE]
    found = reconcile(base, levels, at)
    every = list(dict.fromkeys(k for keys in levels for k in keys))
    sides = [n for n in q.names if n != q.mid]
    own = [
        b.select(F.lit(i).alias("level"), *[F.col(k) if k in keys else F.lit(None).cast("string").alias(k) for k in every], *at,
                 *[(F.col(n) - F.col(q.mid)).alias(f"_{n}") for n in sides])
        for i, (keys, b) in enumerate(zip(levels, base))
    ]
    offsets = own[0]
    for b in own[1:]:
        offsets = offsets.unionByName(b)
    names = ["level", *every, *at]
    offsets = offsets.withColumnsRenamed({n: f"_{n}" for n in names})
    meets = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    joined = found.join(offsets, meets, "left")
    return joined.select(
        *names, "value", *[F.col("reconciled").alias(n) if n == q.mid else (F.col("reconciled") + F.col(f"_{n}")).alias(n) for n in q.names]
    )
