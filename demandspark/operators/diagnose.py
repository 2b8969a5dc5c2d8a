"""Diagnostics of history and forecasts, for all series in one plan.

Operators that order a series by date expect one row per series and day
(``assert_daily_grain``), which bounds a window partition by the calendar.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.columns import interpolated, weekday_name
from demandspark.functions.stats import guarded_corr
from demandspark.spec import (
    BRANCH, DATE, DEMAND, FORECAST_STEP, WEEKDAY, ForecastSpec,
)
from demandspark.staging import staged

# Whisker length, strong-correlation limit, normal 95 % bound.
IQR_FACTOR = 1.5
STRONG_CORRELATION = 0.7
NORMAL_95 = 1.96
# Standard deviations of a normal sample for one median absolute deviation.
MAD_TO_STD = 1.4826


def with_iqr_bounds(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Quartiles of the series and the outlier bounds beside every row; one shuffle."""
    series = Window.partitionBy(*spec.keys)
    quartiles = F.percentile(DEMAND, F.array(F.lit(0.25), F.lit(0.75))).over(series)
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    reach = (q3 - q1) * IQR_FACTOR
    return history.withColumn("_q", quartiles).withColumns(
        {"q1": q1, "q3": q3, "lower": q1 - reach, "upper": q3 + reach}
    ).drop("_q")


def _is_outlier():
    return (F.col(DEMAND) < F.col("lower")) | (F.col(DEMAND) > F.col("upper"))


def iqr_outliers(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Rows strictly outside the bounds of their series."""
    return with_iqr_bounds(history, spec).where(_is_outlier())


def outlier_report(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Per series with outliers: count, share, distinct dates and value range."""
    hit = _is_outlier()
    return (
        with_iqr_bounds(history, spec)
        .groupBy(*spec.keys)
        .agg(
            F.count_if(hit).alias("n_outliers"),
            F.count("*").alias("n_rows"),
            # Distinct days of one series: bounded by the calendar.
            F.sort_array(F.collect_set(F.when(hit, F.col(DATE)))).alias("dates"),
            F.min(F.when(hit, F.col(DEMAND))).alias("min_outlier"),
            F.max(F.when(hit, F.col(DEMAND))).alias("max_outlier"),
        )
        .where("n_outliers > 0")
        .withColumn("pct_outliers", F.col("n_outliers") / F.col("n_rows") * 100)
    )


def outliers_by_weekday(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    return (
        iqr_outliers(history, spec)
        .groupBy(*spec.keys, weekday_name(F.col(DATE)).alias(WEEKDAY))
        .agg(F.count("*").alias("n_outliers"))
    )


def with_moving_bounds(
    history: DataFrame, reach: int = 7, factor: float = 3.0, spec: ForecastSpec = ForecastSpec()
) -> DataFrame:
    """``moving_median``, ``moving_mad`` and their bounds beside every row, from ``reach`` rows on each side.

    The middle of the window follows the level of a series, where one bound for all of it
    calls a whole season an outlier. A frame holds at most ``2 * reach + 1`` values, sorted
    once; null demand is not among them.
    """
    near = Window.partitionBy(*spec.keys).orderBy(DATE).rowsBetween(-reach, reach)
    median, mad = F.col("moving_median"), F.col("moving_mad")
    away = F.array_sort(F.transform("_near", lambda x: F.abs(x - median)))
    return (
        history.withColumn("_near", F.array_sort(F.collect_list(F.col(DEMAND).cast("double")).over(near)))
        .withColumn("moving_median", interpolated(F.col("_near"), 0.5))
        .withColumn("_away", away)
        .withColumn("moving_mad", interpolated(F.col("_away"), 0.5))
        .withColumns({"lower": median - factor * MAD_TO_STD * mad, "upper": median + factor * MAD_TO_STD * mad})
        .drop("_near", "_away")
    )


def hampel_outliers(
    history: DataFrame, reach: int = 7, factor: float = 3.0, spec: ForecastSpec = ForecastSpec()
) -> DataFrame:
    """Rows strictly outside the bounds of their moving window."""
    return with_moving_bounds(history, reach, factor, spec).where(_is_outlier())


def forecast_consistency(evaluation: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Target dates whose middle forecasts differ between steps."""
    mid = F.col(spec.quantiles.mid)
    return (
        evaluation.groupBy(*spec.keys, DATE)
        .agg(
            F.count("*").alias("n_forecasts"),
            F.count_distinct(mid).alias("_values"),
            F.bool_or(mid.isNull()).alias("_has_null"),
            F.stddev_samp(mid).alias("p50_std"),
            (F.max(mid) - F.min(mid)).alias("p50_range"),
        )
        # A missing forecast counts as a value of its own.
        .withColumn("n_values", F.col("_values") + F.col("_has_null").cast("long"))
        .where("n_forecasts > 1 and n_values > 1")
        .drop("_values", "_has_null")
    )


def consistency_steps(evaluation: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """The forecasts behind the inconsistent dates, one row per step."""
    dates = forecast_consistency(evaluation, spec).select(*spec.keys, DATE)
    return evaluation.select(*spec.keys, DATE, FORECAST_STEP, spec.quantiles.mid).join(
        dates, [*spec.keys, DATE], "left_semi"
    )


def with_row_lags(history: DataFrame, lags: int, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Demand shifted by 1..lags rows; one window, so one sort."""
    by_date = Window.partitionBy(*spec.keys).orderBy(DATE)
    return history.withColumns({f"lag_{k}": F.lag(DEMAND, k).over(by_date) for k in range(1, lags + 1)})


def with_day_lags(history: DataFrame, lags: int, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Demand 1..lags calendar days earlier, null where that day has no row.

    Each row is handed to the days that look back at it: keys spread over all tasks.
    """
    shifts = F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("_shift")
    def shifted(k):
        return F.max(F.when(F.col("_shift") == k, F.col(DEMAND)))

    return (
        history.select(*spec.keys, F.col(DATE).alias("_from"), DEMAND, shifts)
        .withColumn(DATE, F.date_add("_from", F.col("_shift")))
        .groupBy(*spec.keys, DATE)
        .agg(
            shifted(0).alias(DEMAND),
            F.bool_or(F.col("_shift") == 0).alias("_present"),
            *[shifted(k).alias(f"lag_{k}") for k in range(1, lags + 1)],
        )
        .where("_present")
        .drop("_present")
    )


def autocorrelation(
    history: DataFrame, max_lags: int = 7, spec: ForecastSpec = ForecastSpec(), calendar: bool = False
) -> DataFrame:
    """Correlation of a series with itself k rows (or calendar days) earlier.

    ``strong`` marks sizes above 0.7; ``bound`` is the 95 % limit of white noise.
    """
    lagged = (with_day_lags if calendar else with_row_lags)(history, max_lags, spec)
    wide = lagged.groupBy(*spec.keys).agg(
        F.count("*").alias("n_rows"),
        *[
            guarded_corr(F.col(DEMAND), F.col(f"lag_{k}")).alias(f"acf_{k}")
            for k in range(1, max_lags + 1)
        ],
    )
    lag_rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("lag"), F.col(f"acf_{k}").alias("acf"))
                for k in range(1, max_lags + 1)
            ]
        )
    )
    return wide.select(*spec.keys, "n_rows", lag_rows.alias("a")).select(
        *spec.keys,
        "n_rows",
        "a.lag",
        "a.acf",
        (F.lit(NORMAL_95) / F.sqrt("n_rows")).alias("bound"),
        F.coalesce(F.abs("a.acf") > STRONG_CORRELATION, F.lit(False)).alias("strong"),
    )


def valid_combinations(wanted: DataFrame, history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Wanted series and whether the data has them."""
    keys = [k for k in spec.keys if k in wanted.columns]
    known = history.select(*keys).distinct().withColumn("_known", F.lit(True))
    return wanted.join(known, keys, "left").select(
        *wanted.columns, F.coalesce("_known", F.lit(False)).alias("exists")
    )


def branch_patterns(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Size, mean, spread and share of branch demand for each series of a branch."""
    per_series = history.groupBy(*spec.keys).agg(
        F.count("*").alias("n_rows"),
        F.avg(DEMAND).alias("mean"),
        F.stddev_samp(DEMAND).alias("std"),
        F.sum(DEMAND).alias("total"),
    )
    # A branch may hold any number of series: its total combines map-side, and the join can be split.
    per_series = staged(per_series, "branch-series")
    branch = [k for k in spec.keys if k in ("CountryCode", BRANCH)]
    sums = per_series.groupBy(*[F.col(k).alias(f"_of_{k}") for k in branch]).agg(F.sum("total").alias("_branch_total"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in branch])
    joined = per_series.join(staged(sums, "branch-totals"), same, "left")
    return joined.select(*per_series.columns, F.try_divide(F.col("total"), F.col("_branch_total")).alias("share"))


def seasonal_patterns(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Mean and spread by weekday and by month, and the ratio to the series mean.

    Each row counts for its weekday, its month and the series as a whole; the three are
    told apart by ``kind`` and summed in one map-side combined aggregate.
    """
    kinds = F.explode(
        F.array(
            F.struct(F.lit("weekday").alias("kind"), weekday_name(F.col(DATE)).alias("period")),
            F.struct(F.lit("month").alias("kind"), F.date_format(DATE, "MM").alias("period")),
            F.struct(F.lit("series").alias("kind"), F.lit("all").alias("period")),
        )
    )
    periods = (
        history.select(*spec.keys, DEMAND, kinds.alias("_k"))
        .groupBy(*spec.keys, F.col("_k.kind").alias("kind"), F.col("_k.period").alias("period"))
        .agg(
            F.count(DEMAND).alias("n_rows"),
            F.avg(DEMAND).alias("mean"),
            F.stddev_samp(DEMAND).alias("std"),
        )
    )
    # At most 7 + 12 + 1 periods per series: a small window partition.
    series_mean = F.max(F.when(F.col("kind") == "series", F.col("mean"))).over(
        Window.partitionBy(*spec.keys)
    )
    return periods.withColumn("ratio", F.try_divide(F.col("mean"), series_mean)).where(
        "kind <> 'series'"
    )
