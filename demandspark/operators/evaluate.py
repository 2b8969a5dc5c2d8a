"""Accuracy, coverage and the statistics report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.columns import safe_scale
from demandspark.functions.quantiles import exact_quantiles
from demandspark.functions.stats import describe_columns, root_mean_square
from demandspark.spec import DATE, DEMAND, ForecastSpec
from demandspark.staging import staged

# Describe quartiles, z-score limit of an extreme forecast.
QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
EXTREME_Z = 5.0


def describe_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of ``value`` per group, exact at any group size."""
    moments = df.groupBy(*keys).agg(*describe_columns(F.col(value)))
    quartiles = exact_quantiles(df, keys, value, list(QUARTILES.values()), list(QUARTILES))
    same = reduce(lambda a, b: a & b, [F.col(f"m.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys])
    return moments.alias("m").join(quartiles.alias("q"), same, "left").select(
        *[F.col(f"m.{k}").alias(k) for k in keys], "count", "mean", "std", "min", *[F.col(f"`{q}`") for q in QUARTILES], "max"
    )


def melt_quantiles(df: DataFrame, keep: Sequence[str], spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """One row per quantile: columns ``quantile`` and ``value``."""
    return df.unpivot(
        [F.col(k) for k in keep], [F.col(n) for n in spec.quantiles.names], "quantile", "value"
    )


def describe_forecasts(forecasts: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Describe table per scaling group and quantile. Scans ``forecasts`` several times: stage it."""
    long = melt_quantiles(forecasts, spec.scaling_keys, spec)
    return describe_by(long, [*spec.scaling_keys, "quantile"], "value")


def forecast_flags(
    forecasts: DataFrame, params: DataFrame, spec: ForecastSpec = ForecastSpec()
) -> DataFrame:
    """Per scaling group and quantile: rows, extreme z-scores against training, negatives."""
    keys = list(spec.scaling_keys)
    p = params.select(*keys, F.col("mean").alias("_m"), safe_scale(F.col("std")).alias("_s"))
    z = F.abs(F.try_divide(F.col("value") - F.col("_m"), F.col("_s")))
    return (
        melt_quantiles(forecasts, keys, spec)
        .join(p, keys)
        .groupBy(*keys, "quantile")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(z > EXTREME_Z).alias("outliers"),
            F.count_if(F.col("value") < 0).alias("negative_values"),
        )
    )


def group_flags(flags: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Any negative, any extreme value over all quantiles of a scaling group."""
    return flags.groupBy(*spec.scaling_keys).agg(
        F.bool_or(F.col("negative_values") > 0).alias("negative_values"),
        F.bool_or(F.col("outliers") > 0).alias("extreme_outliers"),
    )


def accuracy_by_series(evaluation: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """MAPE, interval coverage and RMSE per series, with the counts behind them.

    ``mape`` divides by signed demand and leaves zero demand out; ``mape_abs`` divides
    by its size. A row with a missing side is not covered but counts in the share.
    """
    q = spec.quantiles
    d, mid = F.col(DEMAND), F.col(q.mid)
    miss = F.abs(d - mid)
    covered = F.coalesce((d >= F.col(q.low)) & (d <= F.col(q.high)), F.lit(False))
    return evaluation.groupBy(*spec.keys).agg(
        (F.avg(F.try_divide(miss, d)) * 100).alias("mape"),
        (F.avg(F.try_divide(miss, F.abs(d))) * 100).alias("mape_abs"),
        (F.avg(covered.cast("int")) * 100).alias("coverage"),
        root_mean_square(d - mid).alias("rmse"),
        F.count("*").alias("n_rows"),
        F.count(d - mid).alias("n_scored"),
        F.count_if(d == 0).alias("n_zero_demand"),
    )


def with_status(accuracy: DataFrame) -> DataFrame:
    """``error`` where no MAPE could be computed, else ``success``."""
    failed = F.col("mape").isNull()
    return accuracy.withColumns(
        {
            "status": F.when(failed, "error").otherwise("success"),
            "error": F.when(failed, "no row with demand and forecast"),
        }
    )


def accuracy_summary(accuracy: DataFrame) -> DataFrame:
    """Per metric over all series: successes, failures and a describe table."""
    scored = staged(with_status(accuracy).select("status", "mape", "coverage"), "accuracy")
    long = scored.unpivot(["status"], ["mape", "coverage"], "metric", "value")
    ok = long.where("status = 'success'")
    totals = long.groupBy("metric").agg(
        F.count("*").alias("n_series"),
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(F.col("status") == "error").alias("n_error"),
    )
    return totals.join(describe_by(ok, ["metric"], "value"), "metric", "left")


def holdout_accuracy(
    future: DataFrame, forecasts: DataFrame, spec: ForecastSpec = ForecastSpec()
) -> DataFrame:
    """Held-out demand scored against forecasts made for its days."""
    rows = future.select(*spec.keys, DATE, DEMAND).join(
        forecasts.select(*spec.keys, DATE, *spec.quantiles.names), [*spec.keys, DATE], "left"
    )
    return accuracy_by_series(rows, spec)
