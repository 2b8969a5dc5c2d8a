"""Backtests at past origins and the choice of the best forecaster per series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.forecasters.base import Forecaster, score_origins
from demandspark.functions.stats import root_mean_square
from demandspark.operators.grid import all_origins, origin_grid
from demandspark.operators.prepare import series_template
from demandspark.operators.reshape import evaluation_table
from demandspark.spec import COUNTRY, DATE, DEMAND, ForecastSpec
from demandspark.staging import staged


def backtest(
    history: DataFrame, forecaster: Forecaster, origins: DataFrame | None = None
) -> DataFrame:
    """Score every series from every origin (default: all dates of its country)."""
    spec = forecaster.spec
    template = series_template(history, spec.keys)
    if origins is None:
        return _scored(forecaster, history, template, all_origins(history))
    if forecaster.lookback_days is not None:
        history = since_origins(history, origins, forecaster.lookback_days)
    return _scored(forecaster, history, template, origins)


def _scored(forecaster: Forecaster, history: DataFrame, template: DataFrame, origins: DataFrame) -> DataFrame:
    return score_origins(forecaster, forecaster.fit(history), origin_grid(template, origins))


def since_origins(history: DataFrame, origins: DataFrame, days: int) -> DataFrame:
    """History that reaches at most ``days`` days before its country's first origin."""
    first = staged(origins.groupBy(COUNTRY).agg(F.min(DATE).alias("_first")), "first-origins")
    recent = F.col(DATE) > F.date_sub(F.col("_first"), days)
    return history.join(first, COUNTRY).where(recent).select(*history.columns)


def candidate_errors(history: DataFrame, candidates: Sequence[Forecaster]) -> DataFrame:
    """RMSE of the middle quantile per series and candidate, over all origins and days."""
    def errors(c: Forecaster) -> DataFrame:
        scored = evaluation_table(backtest(history, c), history, c.spec)
        return (
            scored.groupBy(*c.spec.keys)
            .agg(
                F.round(root_mean_square(F.col(DEMAND) - F.col(c.spec.quantiles.mid)), 6).alias("rmse"),
                F.count(F.col(DEMAND) - F.col(c.spec.quantiles.mid)).alias("n_scored"),
            )
            .withColumn("candidate", F.lit(c.name))
        )

    return reduce(DataFrame.unionByName, [errors(c) for c in candidates])


def select_candidate(errors: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Lowest RMSE per series; ties go to the first name."""
    best = F.min(F.when(F.col("rmse").isNotNull(), F.struct("rmse", "candidate")))
    # Staged for the same reason as in ``carry_forward``: the candidates' tables are
    # partitioned alike and share exchanges, and a union of them must be shuffled anew.
    return (
        staged(errors, "errors").groupBy(*spec.keys).agg(best.alias("b"))
        .select(*spec.keys, F.col("b.candidate").alias("candidate"), F.col("b.rmse").alias("rmse"))
    )
