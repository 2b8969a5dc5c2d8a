"""Forecasters against plain Python, and properties every one of them has."""

import math
from datetime import timedelta
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.catalogue.registry import rounded
from demandspark.forecasters import (
    ExponentialSmoothing, LagRegression, SeasonalNaive, TrailingQuantile, WeekdayQuantile, backtest,
    candidate_errors, iterative_forecast, select_candidate,
)
from demandspark.operators.grid import latest_origin
from demandspark.plans.backtesting import train_and_backtest
from demandspark.plans.logged import logged_forecast
from demandspark.plans.scaled import score_scaled, scaled_forecast, train_scaled
from demandspark.spec import ForecastSpec
from tests.helpers import A, B, C, day, demand, rows

SPEC = ForecastSpec(horizon=9, trailing_rows=5, weekday_weeks=3)
P = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def values(seed, n, gaps=()):
    rng = np.random.default_rng(seed)
    return [... if i in gaps else round(float(100 + 20 * math.sin(i) + rng.normal(0, 5)), 3) for i in range(n)]


@pytest.fixture(scope="module")
def data():
    return {A: values(1, 40, {3, 4, 17, 30}), B: [..., ..., *values(2, 30, {9})], C: values(3, 12)}


@pytest.fixture(scope="module")
def history(spark, data):
    return demand(spark, data).cache()


def dated(data, key):
    return {day(i): v for i, v in enumerate(data[key]) if v is not ...}


def quantiles(xs):
    return tuple(float(np.quantile(xs, p)) for p in P.values()) if xs else (None, None, None)


def check(scored, data, expected):
    """``expected(history of one series, origin, target)`` for every row of the full grid."""
    got = scored.collect()
    origins = {c: sorted({d for k in data if k[2] == c for d in dated(data, k)}) for c in ("ZM", "ZA")}
    assert len(got) == sum(len(origins[k[2]]) for k in data) * SPEC.horizon
    for r in got:
        want = expected(dated(data, (r.ProductId, r.BranchId, r.CountryCode, r.Currency)), r.EffectiveDate, r.ForecastDate)
        for name, w in zip(P, want):
            assert (r[name] is None) == (w is None), r
            assert w is None or r[name] == pytest.approx(w, rel=1e-9), r


def test_trailing_quantile(history, data):
    def expected(h, origin, target):
        past = [h[d] for d in sorted(h) if d <= origin]
        return quantiles(past[-SPEC.trailing_rows:])

    check(backtest(history, TrailingQuantile(SPEC)), data, expected)


def test_weekday_quantile(history, data):
    def expected(h, origin, target):
        first = origin - timedelta(days=7 * SPEC.weekday_weeks)
        return quantiles([v for d, v in h.items() if first < d <= origin and d.weekday() == target.weekday()])

    check(backtest(history, WeekdayQuantile(SPEC)), data, expected)


def test_seasonal_naive(history, data):
    def expected(h, origin, target):
        past = [h[d] for d in sorted(h) if d <= origin and d.weekday() == target.weekday()]
        if not past:
            return (None, None, None)
        misses = [b - a for a, b in zip(past, past[1:])][-SPEC.weekday_weeks:]
        # The frame holds rows, and a weekday's first row has no miss.
        if len(past) <= SPEC.weekday_weeks:
            misses = [b - a for a, b in zip(past, past[1:])]
        low, _, high = quantiles(misses)
        return (None if low is None else past[-1] + low, past[-1], None if high is None else past[-1] + high)

    check(backtest(history, SeasonalNaive(SPEC)), data, expected)


def test_exponential_smoothing(history, data):
    z = NormalDist().inv_cdf(0.9)
    seen = 0
    for r in backtest(history, ExponentialSmoothing(0.4, SPEC)).collect():
        h = dated(data, (r.ProductId, r.BranchId, r.CountryCode, r.Currency))
        past = {d: v for d, v in h.items() if d <= r.EffectiveDate}
        if not past:
            assert (r.p10, r.p50, r.p90) == (None, None, None)
            continue
        w = np.array([0.6 ** (max(past) - d).days for d in past])
        y = np.array(list(past.values()))
        level = (w * y).sum() / w.sum()
        spread = math.sqrt((w * (y - level) ** 2).sum() / w.sum())
        assert (r.p10, r.p50, r.p90) == pytest.approx((level - z * spread, level, level + z * spread), rel=1e-6)
        seen += 1
    assert seen > 300


def test_smoothing_of_a_series_that_ended_long_ago(spark):
    old = demand(spark, {A: [1, 2]}).withColumn("EffectiveDate", F.date_sub("EffectiveDate", 3000))
    both = old.union(demand(spark, {B: [4, 5]}))
    scored = backtest(both, ExponentialSmoothing(0.4, SPEC), latest_origin(both))
    assert scored.where("p50 is null").isEmpty()


def lagged(h, origin, target):
    """Feature vector of a plain loop, or None before the series."""
    past = {d: v for d, v in h.items() if d <= origin}
    if not past:
        return None
    same = [d for d in past if d.weekday() == target.weekday()]
    day_value = past[max(past)]
    week_value = past[max(same)] if same else day_value
    return [1.0, day_value, week_value, float((target - origin).days), 0.0, *[float(target.weekday() == k) for k in range(6)]]


def test_lag_regression_matches_ridge_least_squares(history, data):
    model = LagRegression(None, SPEC, refit_days=7, ridge=1e-3)
    epoch = day(0).__class__(1970, 1, 1)
    block = lambda d: (d - epoch).days // 7
    w0 = np.array(model.prior)
    seen = []  # (block of the target, features, label)
    for key in data:
        h = dated(data, key)
        for target, y in h.items():
            for lead in range(1, SPEC.horizon + 1):
                x = lagged(h, target - timedelta(days=lead), target)
                if x is not None:
                    seen.append((block(target), key, lead, target, np.array(x), y))

    def weights(b):
        rows = [(x, y) for t, _, _, _, x, y in seen if t < b]
        if not rows:
            return w0
        x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        gram = x.T @ x
        scale = np.sqrt(np.maximum(np.diag(gram), 1.0))
        return w0 + np.linalg.solve(gram / np.outer(scale, scale) + 1e-3 * np.eye(len(w0)), x.T @ (y - x @ w0) / scale) / scale

    fitted = {b: weights(b) for b in range(block(day(-20)), block(day(60)))}
    checked = 0
    for r in backtest(history, model).collect():
        key = (r.ProductId, r.BranchId, r.CountryCode, r.Currency)
        x = lagged(dated(data, key), r.EffectiveDate, r.ForecastDate)
        if x is None:
            assert r.p50 is None
            continue
        lead = (r.ForecastDate - r.EffectiveDate).days
        known = sorted((t, y - fitted[block(t - timedelta(days=lead))] @ f) for _, k, n, t, f, y in seen
                       if k == key and n == lead and t <= r.EffectiveDate)
        misses = [m for _, m in known][-SPEC.trailing_rows:]
        point = fitted[block(r.EffectiveDate)] @ np.array(x)
        side = [float(np.quantile(misses, p)) if misses else 0.0 for p in P.values()]
        assert (r.p10, r.p50, r.p90) == pytest.approx([point + s for s in side], rel=1e-6, abs=1e-6)
        checked += 1
    assert checked > 300


def test_every_origin_with_a_past_has_a_lag_forecast(history):
    on = ["ProductId", "BranchId", "CountryCode", "Currency", "EffectiveDate", "ForecastDate"]
    trailing = backtest(history, TrailingQuantile(SPEC)).where("p50 is not null").select(on)
    lag = backtest(history, LagRegression(None, SPEC)).where("p50 is not null").select(on)
    assert trailing.exceptAll(lag).isEmpty() and lag.exceptAll(trailing).isEmpty()


def test_iterative_forecast_matches_a_plain_loop(history, data):
    spec = ForecastSpec(trailing_rows=5, iterative_steps=12)
    got = {(r.ProductId, r.CountryCode, r.ForecastStep): r for r in iterative_forecast(history, spec).collect()}
    last = {"ZM": day(39), "ZA": day(11)}
    assert len(got) == 3 * 12
    for key in data:
        tail = [v for v in data[key] if v is not ...][-5:]
        for step in range(1, 13):
            want = quantiles(tail)
            r = got[key[0], key[2], step]
            assert (r.p10, r.p50, r.p90) == pytest.approx(want)
            assert r.EffectiveDate == last[key[2]] + timedelta(days=step)
            tail = (tail + [want[1]])[-5:]


def test_iterative_forecast_of_a_short_series_grows_its_tail(spark):
    df = demand(spark, {A: [1, 2], B: [4]})
    out = rows(iterative_forecast(df, ForecastSpec(trailing_rows=4, iterative_steps=3)), "ProductId", "ForecastStep", "p50")
    assert out == [("18", 1, 1.5), ("18", 2, 1.5), ("18", 3, 1.5), ("7", 1, 4.0), ("7", 2, 4.0), ("7", 3, 4.0)]


def test_iterative_forecast_keeps_series_without_demand(spark):
    df = demand(spark, {A: [1, 2], B: [4]})
    df = df.withColumn("Demand", F.when(F.col("ProductId") == "18", F.col("Demand")))
    out = rows(iterative_forecast(df, ForecastSpec(trailing_rows=4, iterative_steps=2)), "ProductId", "ForecastStep", "p50")
    assert out == [("18", 1, 1.5), ("18", 2, 1.5), ("7", 1, None), ("7", 2, None)]


MODELS = [TrailingQuantile(SPEC), WeekdayQuantile(SPEC), SeasonalNaive(SPEC), ExponentialSmoothing(0.4, SPEC), LagRegression(None, SPEC)]


@pytest.mark.parametrize("model", MODELS, ids=lambda m: m.name)
def test_no_row_after_the_origin_matters(history, model):
    cut = day(20)
    changed = history.withColumn(
        "Demand", F.when(F.col("EffectiveDate") > cut, F.col("Demand") * -7 + 1).otherwise(F.col("Demand"))
    )
    columns = ["ProductId", "CountryCode", "EffectiveDate", "ForecastDate", "p10", "p50", "p90"]
    early = F.col("EffectiveDate") <= cut
    before = rows(backtest(history, model).where(early), *columns)
    assert before == rows(backtest(changed, model).where(early), *columns)
    assert before != rows(backtest(changed.withColumn("Demand", F.col("Demand") + 1), model).where(early), *columns)


@pytest.mark.parametrize("model", MODELS, ids=lambda m: m.name)
def test_partitioning_does_not_matter(spark, history, model):
    columns = ["ProductId", "CountryCode", "EffectiveDate", "ForecastDate", "p10", "p50", "p90"]
    before = rows(rounded(backtest(history, model), 6), *columns)  # sums may differ in their last bits
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows(rounded(backtest(history.orderBy(F.rand(1)), model), 6), *columns) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("model", MODELS, ids=lambda m: m.name)
def test_saved_parameters_score_the_same(spark, history, model, tmp_path):
    from demandspark.operators.grid import all_origins, origin_grid, with_horizon
    from demandspark.operators.prepare import series_template

    path = str(tmp_path / "model")
    model.fit(history).write.parquet(path)
    grid = with_horizon(origin_grid(series_template(history), all_origins(history)), SPEC)
    columns = ["ProductId", "CountryCode", "EffectiveDate", "ForecastDate", "p50"]
    assert rows(model.predict(spark.read.parquet(path), grid), *columns) == rows(backtest(history, model), *columns)


def test_selection_takes_the_lowest_error_then_the_name(spark):
    errors = spark.createDataFrame(
        [(*A, "b", 1.0), (*A, "a", 1.0), (*A, "c", 0.5), (*B, "b", 2.0), (*B, "a", 2.0), (*C, "a", None)],
        "ProductId string, BranchId string, CountryCode string, Currency string, candidate string, rmse double",
    )
    assert rows(select_candidate(errors), "ProductId", "CountryCode", "candidate") == [
        ("18", "ZA", None), ("18", "ZM", "c"), ("7", "ZM", "a"),
    ]


def test_candidate_errors(history, data):
    got = candidate_errors(history, [WeekdayQuantile(SPEC)]).where("ProductId = '7'").first()
    h = dated(data, B)
    origins = sorted(set(h) | set(dated(data, A)))
    errors = []
    for o in origins:
        for k in range(1, SPEC.horizon + 1):
            t = o + timedelta(days=k)
            first = o - timedelta(days=21)
            past = [v for d, v in h.items() if first < d <= o and d.weekday() == t.weekday()]
            if past and t in h:
                errors.append(h[t] - float(np.quantile(past, 0.5)))
    assert got.n_scored == len(errors)
    assert got.rmse == pytest.approx(math.sqrt(np.mean(np.square(errors))), abs=1e-6)


def test_scaled_plan(history):
    spec = SPEC
    model = train_scaled(history, TrailingQuantile(spec))
    run = score_scaled(model, TrailingQuantile(spec), latest_origin(history))
    assert run.unused.isEmpty()
    plain = backtest(history, TrailingQuantile(spec), latest_origin(history))
    columns = ["ProductId", "CountryCode", "ForecastDate", "p10", "p50", "p90"]
    for a, b in zip(rows(run.forecasts, *columns), rows(plain, *columns)):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])  # quantiles survive a linear map
    assert scaled_forecast(history, TrailingQuantile(spec)).count() == 3
    broken = type(model)(model.scaling.where("CountryCode = 'ZM'"), model.forecaster_params, model.template)
    with pytest.raises(ValueError, match="no scaling parameters"):
        score_scaled(broken, TrailingQuantile(spec), latest_origin(history))


def test_logged_plan(history):
    out = logged_forecast(history, TrailingQuantile(SPEC), latest_origin(history))
    assert out.columns == ["BranchId", "CountryCode", "CountryName", "ProductId", "Currency", "EffectiveDate",
                           "ForecastDate", "p10", "p50", "p90", "horizon_day"]
    # The middle of five values survives a monotone map.
    plain = backtest(history, TrailingQuantile(SPEC), latest_origin(history))
    columns = ["ProductId", "CountryCode", "ForecastDate", "p50"]
    for a, b in zip(rows(out, *columns), rows(plain, *columns)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])
    assert [r[0] for r in rows(out.where("CountryCode = 'ZA'"), "horizon_day")] == sorted(
        range(2, 11), key=str
    )


def test_logged_plan_with_two_inverse_passes(spark):
    df = demand(spark, {A: [0.5, 0.6, 0.7]})
    out = logged_forecast(df, TrailingQuantile(SPEC), latest_origin(df), inverse_passes=2).first()
    assert out.p50 == pytest.approx(math.expm1(0.6))


def test_train_and_backtest_checks_the_grain(history):
    wide = train_and_backtest(history, WeekdayQuantile(SPEC))
    assert wide.count() == history.count()
    assert "DayOfWeekName" in wide.columns and "p90_Day9" in wide.columns
    with pytest.raises(ValueError, match="more than one row"):
        train_and_backtest(history.union(history), WeekdayQuantile(SPEC))
