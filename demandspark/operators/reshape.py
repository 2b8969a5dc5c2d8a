"""Forecast tables: wide, joined to history, and ready for evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.columns import ordered_quantiles, unlog_demand
from demandspark.operators.grid import with_forecast_day, within_horizon
from demandspark.operators.validate import require_columns
from demandspark.spec import (
    DATE, DEMAND, FORECAST_DAY, FORECAST_STEP, TARGET_DATE, ForecastSpec,
)


def order_quantiles(df: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    return df.withColumns(ordered_quantiles(spec.quantiles))


def unlog_quantiles(df: DataFrame, spec: ForecastSpec = ForecastSpec(), passes: int = 1) -> DataFrame:
    return df.withColumns({n: unlog_demand(F.col(n), passes) for n in spec.quantiles.names})


def forecast_long(forecasts: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Numbered forecast days inside the horizon."""
    require_columns(forecasts, [*spec.keys, DATE, TARGET_DATE, *spec.quantiles.names])
    return within_horizon(with_forecast_day(forecasts, spec), spec)


def pivot_forecast(
    forecasts: DataFrame, spec: ForecastSpec = ForecastSpec(), days: Sequence[int] | None = None
) -> DataFrame:
    """One row per series and origin, columns ``{quantile}_Day{n}`` in quantile-major order.

    The days are known, so each cell is a conditional mean: one shuffle with map-side
    combine, where a two-step pivot would aggregate twice.
    """
    days = list(days if days is not None else spec.forecast_days)
    cells = [
        F.avg(F.when(F.col(FORECAST_DAY) == d, F.col(n))).alias(f"{n}_Day{d}")
        for n in spec.quantiles.names
        for d in days
    ]
    return forecasts.groupBy(*spec.keys, DATE).agg(*cells)


def history_with_forecasts(
    history: DataFrame, forecasts: DataFrame, spec: ForecastSpec = ForecastSpec()
) -> DataFrame:
    """History rows beside the forecasts made on their day (wide: one row, long: several)."""
    return history.join(forecasts.hint("merge"), [*spec.keys, DATE], "left")


def step_join(requests: DataFrame, forecasts: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Put one-step forecasts into the empty demand of the request rows."""
    return requests.drop(DEMAND).join(
        forecasts.select(*spec.keys, DATE, F.col("ForecastDemand").alias(DEMAND)),
        [*spec.keys, DATE],
        "left",
    )


def evaluation_table(forecasts: DataFrame, history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Forecasts by target date beside actual demand; EffectiveDate is the target date here."""
    actual = history.select(*spec.keys, F.col(DATE).alias(TARGET_DATE), DEMAND)
    return (
        forecasts.drop(DEMAND)
        .withColumn(FORECAST_STEP, F.datediff(F.col(TARGET_DATE), F.col(DATE)))
        .join(actual, [*spec.keys, TARGET_DATE], "left")
        .select(
            *spec.keys, F.col(TARGET_DATE).alias(DATE), DEMAND, *spec.quantiles.names, FORECAST_STEP
        )
    )


def forecast_band(evaluation: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """What a chart of each series draws: the band, the middle line and the actual."""
    return evaluation.select(
        *spec.keys, DATE, FORECAST_STEP, *spec.quantiles.names, F.col(DEMAND).alias("Actual")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
