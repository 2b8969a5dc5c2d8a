"""Exponentially weighted level and spread."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.chains import alike, padded
from demandspark.operators.grid import carry_forward
from demandspark.shipping import ship_package
from demandspark.spec import DATE, DEMAND, ForecastSpec


def _states(days: list[np.ndarray], values: list[np.ndarray], keep: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted means and spreads up to each row, one row a series; a day's weight falls by ``keep``."""
    width = max(map(len, days))
    day, value = padded(days, width), padded(values, width)
    fall = np.nan_to_num(keep ** np.diff(day, axis=1, prepend=day[:, :1]))
    level, spread = np.empty(day.shape), np.empty(day.shape)
    weight, mean, moment = (np.zeros(len(days)) for _ in range(3))
    for k in range(width):
        weight = weight * fall[:, k] + 1.0
        miss = value[:, k] - mean
        mean = mean + miss / weight
        moment = moment * fall[:, k] + miss * (value[:, k] - mean)
        level[:, k], spread[:, k] = mean, np.sqrt(np.maximum(moment / weight, 0.0))
    return level, spread


@dataclass(frozen=True)
class ExponentialSmoothing:
    """Weights fall by ``1 - alpha`` for each day before a series' own latest row.

    The state after each row follows from the one before; many series (each bounded by the
    calendar at daily grain) advance together, a row of each at a time; origins take the latest state at or before them.
    The band is normal with the weighted variance.
    """

    alpha: float = 0.3
    spec: ForecastSpec = field(default_factory=ForecastSpec)
    name: str = "exp_smoothing"
    lookback_days: int | None = None
    needs_target: bool = False

    def fit(self, history: DataFrame) -> DataFrame:
        keep = 1.0 - self.alpha
        rows = history.where(F.col(DEMAND).isNotNull()).select(*self.spec.keys, DATE, F.col(DEMAND).cast("double"))
        row = F.struct(F.unix_date(DATE).alias("d"), F.col(DEMAND).alias("y"))
        series = rows.groupBy(*self.spec.keys).agg(F.array_sort(F.collect_list(row)).alias("_rows")).select(
            *self.spec.keys, F.col("_rows.d").alias("d"), F.col("_rows.y").alias("y")
        )
        kept = [*self.spec.keys, "d"]
        numbers = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("level", "spread")]
        schema = T.StructType([*[series.schema[c] for c in kept], *numbers])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                days, values = ([np.asarray(x, float) for x in b[c]] for c in ("d", "y"))
                level, spread = [None] * len(b), [None] * len(b)
                for some in alike([len(d) for d in days]):
                    states = _states([days[i] for i in some], [values[i] for i in some], keep)
                    for i, mean, width in zip(some, *states):
                        level[i], spread[i] = mean[: len(days[i])], width[: len(days[i])]
                yield b[kept].assign(level=level, spread=spread)

        ship_package(history.sparkSession)
        states = F.explode(F.arrays_zip("d", "level", "spread")).alias("s")
        return series.mapInPandas(run, schema).select(*self.spec.keys, states).select(
            *self.spec.keys, F.date_from_unix_date("s.d").alias(DATE), "s.level", "s.spread"
        )

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame:
        carried = carry_forward(grid, params, self.spec.keys, ["level", "spread"])
        return carried.select(*grid.columns, *[
            (F.col("level") + F.lit(NormalDist().inv_cdf(p)) * F.col("spread")).alias(n)
            for n, p in self.spec.quantiles.levels
        ])
