"""Train, score every origin, shape, and put the forecasts beside the history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from demandspark.forecasters.base import Forecaster
from demandspark.forecasters.selection import backtest
from demandspark.operators.prepare import add_calendar, prepare_demand
from demandspark.operators.reshape import forecast_long, history_with_forecasts, pivot_forecast
from demandspark.staging import staged


def train_and_backtest(
    demand: DataFrame, forecaster: Forecaster, origins: DataFrame | None = None
) -> DataFrame:
    """History rows with the wide forecasts made on their day.

    The checked history is written once, as it feeds the fit, the series list, the
    origins and the final join; everything after it is one lazy plan.
    """
    spec = forecaster.spec
    history = staged(prepare_demand(demand, daily=True), "history")
    wide = pivot_forecast(forecast_long(backtest(history, forecaster, origins), spec), spec)
    return history_with_forecasts(add_calendar(history), wide, spec)
