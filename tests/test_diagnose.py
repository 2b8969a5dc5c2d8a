"""Diagnostics against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators.diagnose import (
    autocorrelation, branch_patterns, consistency_steps, forecast_consistency, hampel_outliers, iqr_outliers, outlier_report,
    outliers_by_weekday, seasonal_patterns, valid_combinations, with_day_lags,
)
from demandspark.plans.diagnosis import full_diagnosis, section_counts
from tests.helpers import A, B, C, SERIES, day, demand, rows
from tests.test_evaluate import EVALUATION


def test_outliers_are_strictly_outside(spark):
    # Quartiles 2 and 4: bounds -1 and 7.
    df = demand(spark, {A: [1, 2, 3, 4, 7], B: [1, 2, 3, 4, 7.5], C: [5]})
    assert rows(iqr_outliers(df), "ProductId", "Demand", "upper") == [("7", 7.5, 7.0)]
    r = outlier_report(df).first()
    assert (r.n_outliers, r.n_rows, r.pct_outliers, r.dates, r.min_outlier) == (1, 5, 20.0, [day(4)], 7.5)
    assert rows(outliers_by_weekday(df), "ProductId", "DayOfWeekName", "n_outliers") == [("7", "Friday", 1)]


def autocorr(x, k):
    a, b = np.array(x[k:]), np.array(x[:-k])
    with np.errstate(all="ignore"):
        r = np.corrcoef(a, b)[0, 1]
    return None if math.isnan(r) else r


def test_autocorrelation_by_row(spark):
    x = [1.0, 5, 2, 8, 3, 9, 1, 7, 2, 6, 4, 8]
    df = demand(spark, {A: [x[0], ..., ..., *x[1:]], B: [4] * 9, C: [1, 2]})
    got = {(r.ProductId, r.CountryCode, r.lag): r for r in autocorrelation(df).collect()}
    assert len(got) == 21
    for k in range(1, 8):
        r = got["18", "ZM", k]
        assert r.acf == pytest.approx(autocorr(x, k))  # the gap is ignored
        assert r.bound == pytest.approx(1.96 / math.sqrt(12)) and r.strong == (abs(r.acf) > 0.7)
        assert got["7", "ZM", k].acf is None and got["7", "ZM", k].strong is False
        assert got["18", "ZA", k].acf is None


def test_autocorrelation_by_calendar_day(spark):
    df = demand(spark, {A: [1, 5, ..., 8, 3, 9, ..., 7]})
    assert rows(with_day_lags(df, 1), "EffectiveDate", "Demand", "lag_1") == [
        (day(0), 1.0, None), (day(1), 5.0, 1.0), (day(3), 8.0, None), (day(4), 3.0, 8.0), (day(5), 9.0, 3.0),
        (day(7), 7.0, None),
    ]
    r = autocorrelation(df, 1, calendar=True).first()
    assert r.n_rows == 6 and r.acf == pytest.approx(np.corrcoef([5, 3, 9], [1, 8, 3])[0, 1])


def consistency(spark):
    cells = [
        (*A, day(5), 1.0, 0.0, 10.0, 20.0, 1), (*A, day(5), 1.0, 0.0, 14.0, 20.0, 2),  # differ
        (*A, day(6), 1.0, 0.0, 10.0, 20.0, 1), (*A, day(6), 1.0, 0.0, 10.0, 20.0, 2),  # agree
        (*A, day(7), 1.0, 0.0, 10.0, 20.0, 1),  # single
        (*A, day(8), 1.0, 0.0, 10.0, 20.0, 1), (*A, day(8), 1.0, 0.0, None, 20.0, 2),  # one missing
    ]
    return spark.createDataFrame(cells, EVALUATION)


def test_consistency(spark):
    got = forecast_consistency(consistency(spark))
    assert rows(got, "EffectiveDate", "n_forecasts", "n_values", "p50_range") == [
        (day(5), 2, 2, 4.0), (day(8), 2, 2, 0.0),
    ]
    assert got.where(F.col("EffectiveDate") == day(5)).first().p50_std == pytest.approx(math.sqrt(8))
    assert rows(consistency_steps(consistency(spark)), "EffectiveDate", "ForecastStep", "p50") == [
        (day(5), 1, 10.0), (day(5), 2, 14.0), (day(8), 1, 10.0), (day(8), 2, None),
    ]


def test_patterns(spark):
    df = demand(spark, {A: [10, 20, 30, 40, 50, 60, 70, 80], B: [20, 20], C: [1]})
    got = {r.ProductId: r for r in branch_patterns(df).where("BranchId = '11'").collect()}
    assert got["18"].share == pytest.approx(360 / 400) and got["7"].share == pytest.approx(0.1)
    a = {(r.kind, r.period): r for r in seasonal_patterns(df).where("ProductId = '18' and CountryCode = 'ZM'").collect()}
    assert a["weekday", "Monday"].mean == 45 and a["weekday", "Monday"].ratio == pytest.approx(1.0)
    assert a["month", "01"].n_rows == 8 and len(a) == 8


def test_branch_totals_need_no_window_and_match_null_branches(spark):
    df = demand(spark, {A: [30], B: [10]}).withColumn("BranchId", F.lit(None).cast("string"))
    got = branch_patterns(df)
    assert {r.ProductId: r.share for r in got.collect()} == {"18": 0.75, "7": 0.25}
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_valid_combinations(spark):
    df = demand(spark, {A: [1]})
    wanted = spark.createDataFrame([("18", "11", "USD"), ("18", "99", "USD")], "ProductId string, BranchId string, Currency string")
    assert rows(valid_combinations(wanted, df), "BranchId", "exists") == [("11", True), ("99", False)]


def test_full_diagnosis_keeps_to_the_wanted_series(spark):
    df = demand(spark, {A: [1, 2, 3, 100], B: [1, 2], C: [5]})
    wanted = spark.createDataFrame([A, ("0", "0", "ZM", "USD")], SERIES)
    sections = full_diagnosis(df, consistency(spark), wanted)
    counts = dict(section_counts(sections).collect())
    assert counts["history"] == 4 and counts["branch_patterns"] == 1 and counts["autocorrelation"] == 7
    assert counts["forecast"] == 7 and counts["forecast_consistency"] == 2
    # The share counts the branch's other series as well.
    assert sections["branch_patterns"].first().share == pytest.approx(106 / 109)


def test_moving_bounds_follow_the_level(spark):
    values = [10 * (i // 20) + i % 3 for i in range(60)]
    values[30], values[5] = 25, None
    history = demand(spark, {A: values, B: [7, 7, 7, 9, 7], C: [4]})
    want = []
    for key, series in ((A, values), (B, [7, 7, 7, 9, 7]), (C, [4])):
        for i, v in enumerate(series):
            near = [x for x in series[max(0, i - 4) : i + 5] if x is not None]
            middle = float(np.median(near))
            away = 3.0 * 1.4826 * float(np.median([abs(x - middle) for x in near]))
            if v is not None and abs(v - middle) > away:
                want.append((key[0], key[2], day(i), float(v), middle))
    got = hampel_outliers(history, reach=4)
    assert ("18", "ZM", day(30), 25.0, 11.0) in want and ("7", "ZM", day(3), 9.0, 7.0) in want
    assert rows(got, "ProductId", "CountryCode", "EffectiveDate", "Demand", "moving_median") == sorted(want, key=str)
    assert hampel_outliers(history.limit(0)).isEmpty()
