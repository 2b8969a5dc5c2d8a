"""Training with scaling, and scoring with saved scaling parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from demandspark.forecasters.base import Forecaster, score_origins
from demandspark.operators.evaluate import (
    describe_forecasts, forecast_flags, group_flags,
)
from demandspark.operators.grid import latest_origin, origin_grid
from demandspark.operators.prepare import series_template
from demandspark.operators.reshape import forecast_long, order_quantiles, pivot_forecast
from demandspark.operators.scaling import (
    apply_scaling, inverse_scaling, require_groups, scaling_params, unused_groups, validated_params,
)
from demandspark.operators.validate import assert_daily_grain
from demandspark.sources.params import stats_report


@dataclass(frozen=True)
class ScaledModel:
    """What training leaves behind: scaling and forecaster parameters, and the series."""

    scaling: DataFrame
    forecaster_params: DataFrame
    template: DataFrame


@dataclass(frozen=True)
class ScoredRun:
    """Long forecasts in original units, and the groups that got none."""

    forecasts: DataFrame
    unused: DataFrame


def train_scaled(history: DataFrame, forecaster: Forecaster) -> ScaledModel:
    spec = forecaster.spec
    scaling = scaling_params(history, spec.scaling_keys)
    scaled = apply_scaling(history, scaling, spec.scaling_keys)
    return ScaledModel(scaling, forecaster.fit(scaled), series_template(history, spec.keys))


def score_scaled(model: ScaledModel, forecaster: Forecaster, origins: DataFrame) -> ScoredRun:
    """Check the parameters, score the grid, restore the scale, order the quantiles."""
    spec = forecaster.spec
    validated_params(model.scaling, spec.scaling_keys)
    require_groups(model.template, model.scaling, spec.scaling_keys)
    scored = score_origins(forecaster, model.forecaster_params, origin_grid(model.template, origins))
    restored = inverse_scaling(scored, model.scaling, spec.quantiles.names, spec.scaling_keys)
    forecasts = order_quantiles(restored, spec)
    return ScoredRun(forecasts, unused_groups(model.scaling, model.template, spec.scaling_keys))


def scaled_forecast(
    history: DataFrame, forecaster: Forecaster, origins: DataFrame | None = None
) -> DataFrame:
    """Wide forecasts, by default from the last date of each country."""
    spec = forecaster.spec
    assert_daily_grain(history, spec.keys)
    origins = latest_origin(history) if origins is None else origins
    run = score_scaled(train_scaled(history, forecaster), forecaster, origins)
    return pivot_forecast(forecast_long(run.forecasts, spec), spec)


def forecast_report(forecasts: DataFrame, params: DataFrame, forecaster: Forecaster) -> DataFrame:
    """Nested statistics report; pass a table or a staged frame, it is read several times."""
    spec = forecaster.spec
    flags = forecast_flags(forecasts, params, spec)
    described = describe_forecasts(forecasts, spec).join(flags, [*spec.scaling_keys, "quantile"])
    return stats_report(described, group_flags(flags, spec), params, spec)
