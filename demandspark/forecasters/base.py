"""What a forecaster offers."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame

from demandspark.operators.grid import with_horizon
from demandspark.spec import ForecastSpec


class Forecaster(Protocol):
    """Parameters are a DataFrame, so a fitted model is saved and reloaded as a table.

    ``history`` has one row per series and day. ``predict`` keeps every row of the grid
    (series, EffectiveDate = origin, ForecastDate) and may use history up to the origin
    only; quantiles are null where there is nothing to go by. ``lookback_days`` is how
    far before an origin its history reaches, or None when that is not a span of days.
    ``needs_target`` says whether the quantiles of an origin differ by target date.
    """

    name: str
    spec: ForecastSpec
    lookback_days: int | None
    needs_target: bool

    def fit(self, history: DataFrame) -> DataFrame: ...

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame: ...


def score_origins(forecaster: Forecaster, params: DataFrame, origins: DataFrame) -> DataFrame:
    """Forecasts for every horizon day of (series, origin) rows.

    Where the target date plays no part, the horizon is exploded after scoring: the
    rows to be matched with parameters are fewer by the length of the horizon.
    """
    if forecaster.needs_target:
        return forecaster.predict(params, with_horizon(origins, forecaster.spec))
    return with_horizon(forecaster.predict(params, origins), forecaster.spec)
