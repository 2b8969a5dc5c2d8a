"""Grids, origins, as-of states, and shaping."""

import pytest
from pyspark.sql import functions as F

from demandspark.operators.grid import (
    all_origins, carry_forward, latest_origin, origin_batches, origin_grid, request_grid, step_grid,
    with_forecast_day, with_horizon, within_horizon,
)
from demandspark.operators.prepare import series_template
from demandspark.operators.reshape import (
    evaluation_table, forecast_long, history_with_forecasts, pivot_forecast, step_join, union_all,
)
from demandspark.spec import SERIES_KEYS, ForecastSpec
from tests.helpers import A, B, C, day, demand, rows

SPEC = ForecastSpec(horizon=3)


def test_grid_crosses_dates_and_series_within_a_country(spark):
    df = demand(spark, {A: [1, 2, ..., 4], B: [..., 5], C: [1]})
    grid = request_grid(series_template(df), all_origins(df), SPEC)
    assert grid.count() == (2 * 3 + 1 * 1) * 3
    assert grid.where("Demand is not null").isEmpty()
    b = grid.where("ProductId = '7'").select("EffectiveDate").distinct()
    assert rows(b, "EffectiveDate") == [(day(0),), (day(1),), (day(3),)]
    one = grid.where(F.col("EffectiveDate") == day(3)).where("ProductId = '7'")
    assert rows(one, "ForecastDate", "DayOfWeekName") == [
        (day(4), "Friday"), (day(5), "Saturday"), (day(6), "Sunday"),
    ]
    assert request_grid(series_template(df), latest_origin(df), SPEC, demand=0.0).where("Demand = 0").count() == 9


def test_batches_number_sorted_dates(spark):
    df = demand(spark, {A: [1, ..., 1, 1, 1], C: [1]})
    assert rows(origin_batches(all_origins(df), 2), "CountryCode", "EffectiveDate", "batch") == [
        ("ZA", day(0), 1), ("ZM", day(0), 1), ("ZM", day(2), 1), ("ZM", day(3), 2), ("ZM", day(4), 2),
    ]


def test_frequency_of_several_days(spark):
    df = demand(spark, {A: [1]})
    spec = ForecastSpec(horizon=2, freq_days=7)
    grid = with_horizon(origin_grid(series_template(df), all_origins(df)), spec)
    assert rows(grid, "ForecastDate") == [(day(7),), (day(14),)]
    assert spec.forecast_days == [8]


def test_step_grid(spark):
    df = demand(spark, {A: [1, 2], B: [1], C: [1]})
    template = series_template(df)
    grid = step_grid(template.union(template), latest_origin(df))
    assert rows(grid, "ProductId", "CountryCode", "EffectiveDate") == [
        ("18", "ZA", day(1)), ("18", "ZM", day(2)), ("7", "ZM", day(2)),
    ]


@pytest.mark.parametrize("offset,days", [(1, [2, 3]), (0, [1, 2, 3])])
def test_day_numbers_and_horizon_filter(spark, offset, days):
    spec = ForecastSpec(horizon=3, day_offset=offset)
    df = demand(spark, {A: [1]})
    grid = with_horizon(origin_grid(series_template(df), all_origins(df)), spec)
    long = within_horizon(with_forecast_day(grid, spec), spec)
    assert [r[0] for r in rows(long, "ForecastDay")] == days == spec.forecast_days


def test_carry_forward(spark):
    df = demand(spark, {A: [..., 10, ..., ..., 40], B: [1, ..., ..., 4]})
    grid = origin_grid(series_template(df), all_origins(df))
    carried = carry_forward(grid, df.withColumnRenamed("Demand", "s"), SERIES_KEYS, ["s"])
    assert rows(carried.where("ProductId = '18'"), "EffectiveDate", "s") == [
        (day(0), None), (day(1), 10.0), (day(3), 10.0), (day(4), 40.0),
    ]
    assert carried.columns == [*SERIES_KEYS, "EffectiveDate", "s"]


def forecasts(spark):
    """Horizon three from two origins; the quantiles tell origin and day apart."""
    df = demand(spark, {A: [1, 2]})
    grid = with_horizon(origin_grid(series_template(df), all_origins(df)), SPEC)
    step = F.datediff("ForecastDate", "EffectiveDate")
    base = F.day("EffectiveDate") * 10 + step
    return grid.withColumns({"p10": base - 0.5, "p50": base.cast("double"), "p90": base + 0.5})


def test_pivot_is_quantile_major_and_keeps_null_cells(spark):
    long = forecast_long(forecasts(spark), SPEC)
    wide = pivot_forecast(long.withColumn("p90", F.lit(None).cast("double")), SPEC)
    assert wide.columns[5:] == ["p10_Day2", "p10_Day3", "p50_Day2", "p50_Day3", "p90_Day2", "p90_Day3"]
    assert rows(wide, "EffectiveDate", "p50_Day2", "p50_Day3", "p90_Day2") == [
        (day(0), 11.0, 12.0, None), (day(1), 21.0, 22.0, None),
    ]


def test_pivot_and_unpivot_agree(spark):
    long = forecast_long(forecasts(spark), SPEC)
    wide = pivot_forecast(long, SPEC)
    cells = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"p50_Day{d}").alias("v")) for d in (2, 3)]))
    back = wide.select("EffectiveDate", cells.alias("c")).select("EffectiveDate", "c.d", "c.v")
    assert rows(back, "EffectiveDate", "d", "v") == rows(long, "EffectiveDate", "ForecastDay", "p50")


def test_pivot_averages_repeated_cells(spark):
    long = forecast_long(forecasts(spark), SPEC)
    doubled = union_all([long, long.withColumn("p50", F.col("p50") + 2)])
    assert rows(pivot_forecast(doubled, SPEC), "p50_Day2") == [(12.0,), (22.0,)]


def test_history_joins(spark):
    df = demand(spark, {A: [1, 2, 3]})
    long = forecast_long(forecasts(spark), SPEC)
    joined = history_with_forecasts(df, long, SPEC)
    assert joined.count() == 2 * 2 + 1  # two days per origin, and a day without forecasts
    wide = history_with_forecasts(df, pivot_forecast(long, SPEC), SPEC)
    assert rows(wide, "EffectiveDate", "Demand", "p50_Day2") == [
        (day(0), 1.0, 11.0), (day(1), 2.0, 21.0), (day(2), 3.0, None),
    ]


def test_evaluation_is_by_target_date(spark):
    df = demand(spark, {A: [1, 2, 3]})
    ev = evaluation_table(forecasts(spark), df, SPEC)
    assert rows(ev, "EffectiveDate", "ForecastStep", "Demand", "p50") == [
        (day(1), 1, 2.0, 11.0), (day(2), 1, 3.0, 21.0), (day(2), 2, 3.0, 12.0),
        (day(3), 2, None, 22.0), (day(3), 3, None, 13.0), (day(4), 3, None, 23.0),
    ]


def test_step_join_fills_demand(spark):
    df = demand(spark, {A: [1], B: [2]})
    requests = step_grid(series_template(df), latest_origin(df))
    points = spark.createDataFrame([(*A, day(1), 5.0)], "ProductId string, BranchId string, CountryCode string, "
                                   "Currency string, EffectiveDate date, ForecastDemand double")
    assert rows(step_join(requests, points, SPEC), "ProductId", "Demand") == [("18", 5.0), ("7", None)]


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="p90"):
        forecast_long(forecasts(spark).drop("p90"), SPEC)
