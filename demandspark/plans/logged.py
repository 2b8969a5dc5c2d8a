"""Scoring with log-transformed demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.forecasters.base import Forecaster, score_origins
from demandspark.operators.grid import all_origins, origin_grid, with_forecast_day
from demandspark.operators.prepare import (
    country_name, log_transform, repair_nonpositive, series_template,
)
from demandspark.operators.reshape import order_quantiles, unlog_quantiles
from demandspark.operators.validate import assert_daily_grain
from demandspark.spec import (
    BRANCH, COUNTRY, COUNTRY_NAME, CURRENCY, DATE, PRODUCT, TARGET_DATE,
)


def logged_forecast(
    history: DataFrame,
    forecaster: Forecaster,
    origins: DataFrame | None = None,
    inverse_passes: int = 1,
) -> DataFrame:
    """Repair, log, fit, score, undo the log, order the quantiles, number the days.

    ``inverse_passes=2`` undoes the log once more after the quantiles were ordered.
    """
    spec = forecaster.spec
    assert_daily_grain(history, spec.keys)
    origins = all_origins(history) if origins is None else origins
    logged = log_transform(repair_nonpositive(history))
    grid = origin_grid(series_template(history, spec.keys), origins)
    scored = unlog_quantiles(score_origins(forecaster, forecaster.fit(logged), grid), spec)
    ordered = unlog_quantiles(order_quantiles(scored, spec), spec, inverse_passes - 1)
    return (
        with_forecast_day(ordered, spec, "horizon_day")
        .withColumn(COUNTRY_NAME, country_name(F.col(COUNTRY)))
        .select(
            BRANCH, COUNTRY, COUNTRY_NAME, PRODUCT, CURRENCY, DATE, TARGET_DATE,
            *spec.quantiles.names, "horizon_day",
        )
    )
