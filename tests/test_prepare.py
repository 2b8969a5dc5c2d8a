"""Preparation, typing and validation edges."""

import pytest
from pyspark.sql import functions as F

from demandspark.functions.columns import (
    ordered_quantiles, strip_quotes, strip_thousands, to_day, to_number, unlog_demand,
)
from demandspark.operators.prepare import (
    add_calendar, add_missing_columns, flag_holidays, keep_one, log_transform, prefix_keys, prepare_demand,
    repair_nonpositive, series_template, train_future_split,
)
from demandspark.operators.validate import (
    assert_daily_grain, assert_dates, assert_no_nulls, null_counts, require_columns,
)
from demandspark.spec import Quantiles
from tests.helpers import A, B, C, DEMAND_SCHEMA, day, demand, rows


def test_require_columns_lists_the_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        require_columns(df, ["a", "c", "b"])


def test_null_checks(spark):
    df = demand(spark, {A: [1, None, 3], B: [None]})
    assert null_counts(df, ["Demand", "BranchId"]).first().asDict() == {"Demand": 2, "BranchId": 0}
    with pytest.raises(ValueError, match="'Demand': 2"):
        assert_no_nulls(df, ["Demand", "BranchId"])
    assert assert_no_nulls(df, ["BranchId"]) is df


def test_prepare_demand_types_and_failures(spark):
    schema = "ProductId int, BranchId int, CountryCode string, Currency string, EffectiveDate string, Demand string, x int"
    good = [(18, 11, "ZM", "USD", "2023-05-01 23:30:00+05:00", "7.5", 1)]
    df = prepare_demand(spark.createDataFrame(good, schema), daily=True)
    assert "x" not in df.columns
    assert df.first().asDict() == {
        "ProductId": "18", "BranchId": "11", "CountryCode": "ZM", "Currency": "USD",
        "EffectiveDate": __import__("datetime").date(2023, 5, 1), "Demand": 7.5,
    }
    with pytest.raises(ValueError, match="'BranchId': 1"):
        prepare_demand(spark.createDataFrame([(18, None, *good[0][2:])], schema))
    with pytest.raises(ValueError, match="1 'EffectiveDate' entries"):
        prepare_demand(spark.createDataFrame([(18, 11, "ZM", "USD", "yesterday", "1", 1)], schema))
    with pytest.raises(ValueError, match="more than one row"):
        prepare_demand(spark.createDataFrame(good * 2, schema), daily=True)


def test_assert_dates_and_grain(spark):
    df = demand(spark, {A: [1, 2]})
    assert assert_dates(df) is df and assert_daily_grain(df) is df
    with pytest.raises(ValueError, match="could not be parsed"):
        assert_dates(df.withColumn("EffectiveDate", F.lit(None).cast("date")))
    with pytest.raises(ValueError, match="more than one row"):
        assert_daily_grain(df.union(df))


@pytest.mark.parametrize(
    "text,expected",
    [("1.5", 1.5), (" 2 ", 2.0), ("n/a", None), ("", None), ("NaN", None), (None, None), ("1e3", 1000.0)],
)
def test_to_number(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(to_number(F.col("s"))).first()[0] == expected


def test_text_cleaning(spark):
    df = spark.createDataFrame([(' "1,234.50" ',), ("ERROR",), (None,)], "s string")
    cleaned = [r[0] for r in df.select(strip_thousands(strip_quotes(F.col("s")))).collect()]
    assert cleaned == [1234.5, None, None]


def test_wall_clock_day_of_text_with_offset(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-01-01 23:30:00+09:00",), ("2024-02-30",)], "s string")
        assert [r[0] for r in df.select(to_day(F.col("s"))).collect()] == [day(0), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_and_country(spark):
    df = add_calendar(demand(spark, {A: [1], C: [1]}))
    assert rows(df, "CountryCode", "DayOfWeekName", "CountryName") == [
        ("ZA", "Monday", None), ("ZM", "Monday", "Zambia"),
    ]


def test_prefix_and_missing_columns(spark):
    df = demand(spark, {A: [1]})
    assert prefix_keys(df, {"BranchId": "B"}).first().BranchId == "B11"
    with pytest.raises(ValueError, match="Nope"):
        prefix_keys(df, {"Nope": "x"})
    widened = add_missing_columns(df, {"Extra": "double", "BranchId": "string"})
    assert widened.first().Extra is None and widened.first().BranchId == "11"
    assert add_missing_columns(df, {"BranchId": "string"}) is df


def test_repair_is_per_country_and_keeps_nulls(spark):
    df = demand(spark, {A: [0, -5, 200, None], B: [50], C: [-1, 0]})
    assert rows(repair_nonpositive(df), "CountryCode", "ProductId", "Demand") == sorted(
        [("ZM", "18", 0.5), ("ZM", "18", 0.5), ("ZM", "18", 200.0), ("ZM", "18", None), ("ZM", "7", 50.0),
         ("ZA", "18", 0.01), ("ZA", "18", 0.01)],
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )


def test_log_round_trip_and_double_inverse(spark):
    df = demand(spark, {A: [0.01, 5, 1e7]})
    back = log_transform(df).select(unlog_demand(F.col("Demand")).alias("d")).collect()
    assert [r.d for r in back] == pytest.approx([0.01, 5, 1e7])
    twice = spark.createDataFrame([(1.0,), (-3.0,), (None,)], "x double").select(unlog_demand(F.col("x"), 2))
    e = 2.718281828459045
    assert [r[0] for r in twice.collect()] == [pytest.approx(e ** (e - 1) - 1), 0.0, None]


def test_quantile_order_takes_the_other_side_of_a_null(spark):
    df = spark.createDataFrame([(5.0, 3.0, 1.0), (None, 3.0, None), (1.0, None, 9.0)], "p10 double, p50 double, p90 double")
    ordered = df.withColumns(ordered_quantiles(Quantiles()))
    assert [tuple(r) for r in ordered.collect()] == [(3.0, 3.0, 3.0), (3.0, 3.0, 3.0), (1.0, None, 9.0)]


def test_quantile_roles_follow_the_names(spark):
    q = Quantiles((("lo", 0.05), ("mid", 0.5), ("hi", 0.95)))
    df = spark.createDataFrame([(5.0, 3.0, 1.0)], "lo double, mid double, hi double")
    assert tuple(df.withColumns(ordered_quantiles(q)).first()) == (3.0, 3.0, 3.0)


def test_keep_one(spark):
    df = spark.createDataFrame(
        [(*A, day(0), 1.0, 0), (*A, day(0), 2.0, 1), (*A, day(1), None, 0), (*B, day(0), 5.0, 3)],
        DEMAND_SCHEMA + ", source int",
    )
    last = keep_one(df, F.col("source"), "last")
    assert last.columns == df.columns
    assert rows(last, "ProductId", "EffectiveDate", "Demand") == [
        ("18", day(0), 2.0), ("18", day(1), None), ("7", day(0), 5.0),
    ]
    assert rows(keep_one(df, F.col("source"), "first").where("ProductId = '18'"), "Demand") == [(1.0,), (None,)]


def test_split_cutoff_is_per_country(spark):
    df = demand(spark, {A: [1] * 10, B: [1] * 4, C: [1] * 5})
    parts = train_future_split(df, 3).groupBy("ProductId", "CountryCode", "part").count()
    assert {(r[0], r[1], r[2]): r[3] for r in parts.collect()} == {
        ("18", "ZM", "train"): 7, ("18", "ZM", "future"): 3, ("7", "ZM", "train"): 4,
        ("18", "ZA", "train"): 2, ("18", "ZA", "future"): 3,
    }


def test_holidays_repeat_and_other_countries(spark):
    df = demand(spark, {A: [1, 1], C: [1, 1]})
    days = spark.createDataFrame(
        [("ZM", day(0), "a"), ("ZM", day(0), "b"), ("XX", day(1), "c")], "CountryCode string, date date, holiday string"
    )
    assert rows(flag_holidays(df, days), "CountryCode", "EffectiveDate", "IsHoliday") == [
        ("ZA", day(0), False), ("ZA", day(1), False), ("ZM", day(0), True), ("ZM", day(1), False),
    ]


def test_template(spark):
    assert rows(series_template(demand(spark, {A: [1, 2], C: [3]})), "BranchId") == [("11",), ("12",)]
