"""Request grids: which series to forecast, from which origins, for which days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.columns import forecast_day, weekday_name
from demandspark.spec import (
    COUNTRY, DATE, DEMAND, FORECAST_DAY, TARGET_DATE, WEEKDAY, ForecastSpec,
)
from demandspark.staging import spread, staged


def all_origins(history: DataFrame) -> DataFrame:
    """Every distinct history date of a country."""
    return history.select(COUNTRY, DATE).distinct()


def latest_origin(history: DataFrame) -> DataFrame:
    """Only the last history date of a country."""
    return history.groupBy(COUNTRY).agg(F.max(DATE).alias(DATE))


def origin_batches(origins: DataFrame, batch_size: int) -> DataFrame:
    """Number a country's sorted origins in batches from 1.

    Ranks run over distinct dates, so a window partition is bounded by the calendar.
    """
    rank = F.row_number().over(Window.partitionBy(COUNTRY).orderBy(DATE))
    batch = F.ceil(rank / F.lit(batch_size)).cast("int")
    return origins.select(COUNTRY, DATE).distinct().withColumn("batch", batch)


def origin_grid(template: DataFrame, origins: DataFrame) -> DataFrame:
    """Each series at each origin of its country.

    The origins of a country travel as one array (bounded by the calendar) and are
    exploded beside the series, so only the series list is shuffled. An outer join keeps
    the series on the streamed side, however few they are, so the explosion is spread
    over all tasks.
    """
    arrays = staged(
        origins.groupBy(COUNTRY).agg(F.sort_array(F.collect_set(DATE)).alias("_origins")),
        "origins",
    )
    series = spread(staged(template, "template"), *template.columns).join(arrays, COUNTRY, "left")
    return series.select(*template.columns, F.explode_outer("_origins").alias(DATE)).where(
        F.col(DATE).isNotNull()
    )


def with_horizon(origins: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """One row per origin and day ahead."""
    days = F.transform(
        F.sequence(F.lit(1), F.lit(spec.horizon)),
        lambda j: F.date_add(F.col(DATE), (j * spec.freq_days).cast("int")),
    )
    return origins.withColumn(TARGET_DATE, F.explode(days))


def request_grid(
    template: DataFrame, origins: DataFrame, spec: ForecastSpec = ForecastSpec(), demand: float | None = None
) -> DataFrame:
    """Rows to be scored; demand is unknown, and the weekday is that of the target date."""
    return with_horizon(origin_grid(template, origins), spec).withColumns(
        {DEMAND: F.lit(demand).cast("double"), WEEKDAY: weekday_name(F.col(TARGET_DATE))}
    )


def step_grid(template: DataFrame, last_dates: DataFrame, days_ahead: int = 1) -> DataFrame:
    """Each series once, for the day after its country's last date."""
    step = last_dates.select(COUNTRY, F.date_add(F.col(DATE), days_ahead).alias(DATE))
    return (
        template.distinct().join(step, COUNTRY)
        .select(*template.columns, DATE)
        .withColumn(DEMAND, F.lit(None).cast("double"))
    )


def with_forecast_day(df: DataFrame, spec: ForecastSpec = ForecastSpec(), name: str = FORECAST_DAY) -> DataFrame:
    return df.withColumn(name, forecast_day(F.col(TARGET_DATE), F.col(DATE), spec.day_offset))


def within_horizon(df: DataFrame, spec: ForecastSpec = ForecastSpec(), name: str = FORECAST_DAY) -> DataFrame:
    return df.where(F.col(name).between(1, spec.horizon * spec.freq_days))


def carry_forward(
    requests: DataFrame,
    states: DataFrame,
    by: Sequence[str],
    payload: Sequence[str],
    at: str = DATE,
) -> DataFrame:
    """As-of join: the latest state at or before each request, null before the first.

    States and requests are laid in one timeline per ``by`` group and the last seen state
    is carried along it. At daily grain a group is bounded by the calendar.

    The timeline is partitioned by a hash column of its own. Spark 4.1 takes a union of
    two inputs that are partitioned by ``by`` for partitioned as well and skips the
    shuffle; a plan of that shape with reused exchanges gave wrong rows, and right ones
    with ``spark.sql.unionOutputPartitioning`` off.
    """
    timeline = (
        requests.withColumn("_request", F.lit(1))
        .unionByName(
            states.select(
                *by, F.col(at), F.struct(*payload).alias("_state"), F.lit(0).alias("_request")
            ),
            allowMissingColumns=True,
        )
        .withColumn("_group", F.xxhash64(*by))
        .repartition("_group")
    )
    so_far = (
        Window.partitionBy("_group", *by).orderBy(at, "_request")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = timeline.withColumn("_last", F.last("_state", ignorenulls=True).over(so_far))
    return carried.where("_request = 1").select(
        *requests.columns, *[F.col(f"_last.{p}").alias(p) for p in payload]
    )
