"""Accuracy, report and profile edges."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.functions.stats import guarded_corr
from demandspark.operators.evaluate import (
    accuracy_by_series, accuracy_summary, describe_by, forecast_flags, group_flags, holdout_accuracy, with_status,
)
from demandspark.operators.profile import (
    box_stats, column_profile, correlation_matrix, first_rows, histogram, jarque_bera, prediction_sentinels,
)
from demandspark.operators.scaling import scaling_params
from demandspark.plans.scaled import forecast_report
from demandspark.forecasters import TrailingQuantile
from tests.helpers import A, B, SERIES, day, demand, rows

EVALUATION = SERIES + ", EffectiveDate date, Demand double, p10 double, p50 double, p90 double, ForecastStep int"


def evaluation(spark):
    cells = [
        (*A, day(0), 10.0, 8.0, 9.0, 12.0, 1),
        (*A, day(1), 0.0, -1.0, 1.0, 2.0, 1),
        (*A, day(2), -10.0, -8.0, -5.0, 0.0, 1),
        (*A, day(3), None, 1.0, 2.0, 3.0, 1),
        (*A, day(4), 5.0, None, None, None, 1),
        (*B, day(0), 0.0, 0.0, 0.0, 0.0, 1),
    ]
    return spark.createDataFrame(cells, EVALUATION)


def test_accuracy(spark):
    got = {r.ProductId: r for r in accuracy_by_series(evaluation(spark)).collect()}
    a = got["18"]
    assert a.mape == pytest.approx((0.1 - 0.5) / 2 * 100)  # signed demand, zero left out
    assert a.mape_abs == pytest.approx((0.1 + 0.5) / 2 * 100)
    assert a.coverage == pytest.approx(2 / 5 * 100)  # missing sides count as misses
    assert a.rmse == pytest.approx(math.sqrt((1 + 1 + 25) / 3))
    assert (a.n_rows, a.n_scored, a.n_zero_demand) == (5, 3, 1)
    assert got["7"].mape is None and got["7"].coverage == 100


def test_status_and_summary(spark):
    accuracy = accuracy_by_series(evaluation(spark))
    assert rows(with_status(accuracy), "ProductId", "status") == [("18", "success"), ("7", "error")]
    summary = {r.metric: r for r in accuracy_summary(accuracy).collect()}
    assert (summary["mape"].n_series, summary["mape"].n_success, summary["mape"].n_error) == (2, 1, 1)
    assert summary["coverage"]["count"] == 1 and summary["coverage"]["50%"] == pytest.approx(40)


def test_describe_matches_pandas(spark):
    values = [1.0, 2.0, 3.5, 10.0, -4.0, 2.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("b", 7.0)], "g string, x double")
    got = {r.g: r for r in describe_by(df, ["g"], "x").collect()}
    want = [6, np.mean(values), np.std(values, ddof=1), -4.0, *np.quantile(values, [0.25, 0.5, 0.75]), 10.0]
    assert list(got["a"])[1:] == pytest.approx(want)
    assert got["b"].std is None and got["b"]["25%"] == 7.0


def test_holdout(spark):
    future = demand(spark, {A: [1, 2, 3]})
    made = spark.createDataFrame([(*A, day(0), 1.0, 1.0, 1.0), (*A, day(1), 2.0, 4.0, 6.0)],
                                 SERIES + ", EffectiveDate date, p10 double, p50 double, p90 double")
    r = holdout_accuracy(future, made).first()
    assert (r.n_rows, r.n_scored, r.mape) == (3, 2, pytest.approx(50.0))
    assert r.coverage == pytest.approx(200 / 3)


def long_forecasts(spark):
    cells = [
        (*A, day(0), day(1), 1.0, 2.0, 3.0), (*A, day(0), day(2), -1.0, 2.0, 300.0), (*A, day(0), day(3), None, None, None),
        (*B, day(0), day(1), 1.0, 2.0, 4.0),
    ]
    return spark.createDataFrame(cells, SERIES + ", EffectiveDate date, ForecastDate date, p10 double, p50 double, p90 double")


def test_flags_and_nested_report(spark):
    params = scaling_params(demand(spark, {A: [1, 2, 3], B: [2, 3]}))
    forecasts = long_forecasts(spark)
    flags = forecast_flags(forecasts, params)
    assert rows(flags, "quantile", "n_rows", "outliers", "negative_values") == [
        ("p10", 4, 0, 1), ("p50", 4, 0, 0), ("p90", 4, 1, 0),
    ]
    assert rows(group_flags(flags), "negative_values", "extreme_outliers") == [(True, True)]
    report = forecast_report(forecasts, params, TrailingQuantile())
    document = json.loads(report.select(F.to_json(F.struct(*report.columns))).first()[0])
    assert document["n_forecasts"] == 4 and document["validation"] == {"negative_values": True, "extreme_outliers": True}
    assert document["scaling_params"]["n_observations"] == 5
    p90 = document["quantile_stats"]["p90"]
    assert (p90["outliers"], p90["negative_values"]) == (1, 0)
    assert p90["basic_stats"]["count"] == 3 and p90["basic_stats"]["50%"] == 4.0


def test_constant_group_has_divisor_one(spark):
    params = scaling_params(demand(spark, {A: [3, 3]}))
    flags = forecast_flags(long_forecasts(spark).where("ProductId = '18'"), params)
    assert rows(flags.where("quantile = 'p90'"), "outliers") == [(1,)]


def test_guarded_corr(spark):
    df = spark.createDataFrame(
        [("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0), ("line", 9.0, None), ("flat", 1.0, 5.0),
         ("flat", 2.0, 5.0), ("one", 1.0, 1.0)], "g string, x double, y double")
    got = dict(df.groupBy("g").agg(guarded_corr(F.col("x"), F.col("y"))).collect())
    assert got["line"] == pytest.approx(1.0) and got["flat"] is None and got["one"] is None


PROFILE = [(1, 1.0, "a"), (2, 2.0, None), (3, None, "a"), (4, 10.0, "ERROR"), (5, 2.0, "b")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(PROFILE, "id int, x double, s string")


def test_column_profile(table):
    assert rows(column_profile(table), "column", "type", "n_present", "n_null", "n_distinct", "n_rows") == [
        ("id", "int", 5, 0, 5, 5), ("s", "string", 4, 1, 3, 5), ("x", "double", 4, 1, 3, 5),
    ]
    assert rows(column_profile(table, ["id"], approximate=True), "n_distinct") == [(5,)]


def test_correlation_matrix(table):
    got = {(r.x, r.y): r["corr"] for r in correlation_matrix(table).collect()}
    want = np.corrcoef([1, 2, 4, 5], [1, 2, 10, 2])[0, 1]
    assert got["id", "x"] == got["x", "id"] == pytest.approx(want)
    assert got["x", "x"] == pytest.approx(1.0) and len(got) == 4


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(21)], "x double, flat double")
    h = histogram(df, ["x", "flat"])
    assert [r[1] for r in rows(h.where("column = 'x'").select("bin", "n"), "bin", "n")].count(1) == 19
    assert h.where("column = 'x' and bin = 19").first().n == 2
    assert rows(h.where("column = 'flat'"), "bin", "n") == [(0, 21)]


def test_box_stats(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100, -50]], "x double")
    r = box_stats(df, ["x"]).first()
    q = np.quantile([1, 2, 3, 4, 5, 6, 7, 8, 100, -50], [0.25, 0.5, 0.75])
    assert (r.q1, r.median, r.q3) == pytest.approx(tuple(q))
    assert (r.whisker_low, r.whisker_high, r.n_fliers, r.n) == (1.0, 8.0, 2, 10)


def test_jarque_bera(spark):
    x = np.array([1.0, 2.0, 3.0, 10.0, 4.0])
    df = spark.createDataFrame([(float(v), 5.0) for v in x], "x double, flat double")
    got = {r.column: r for r in jarque_bera(df, ["x", "flat"]).collect()}
    z = x - x.mean()
    skew, kurt = (z**3).mean() / (z**2).mean() ** 1.5, (z**4).mean() / (z**2).mean() ** 2 - 3
    assert got["x"].jarque_bera == pytest.approx(len(x) / 6 * (skew**2 + kurt**2 / 4))
    assert got["flat"].jarque_bera is None


def test_sentinels_and_first_rows(table):
    assert rows(prediction_sentinels(table.select("s")), "column", "n_present", "n_sentinel") == [("s", 4, 1)]
    assert [r.id for r in first_rows(table, ["id"], 2).collect()] == [1, 2]
