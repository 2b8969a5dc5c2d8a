"""Fitted quantiles: optimal by their subgradient, right in saturated designs, blind to the future."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.forecasters import QuantileRegression, backtest
from demandspark.functions.quantile_fit import fit_quantiles
from demandspark.spec import ForecastSpec
from demandspark.staging import staged
from tests.helpers import A, B, demand

LEVELS = [0.1, 0.5, 0.9]


def loss(x, y, weights, level):
    miss = y - x @ np.array(weights)
    return np.maximum(miss * level, miss * (level - 1)).mean()


def table(spark, x, y, block=None):
    columns = [f"f{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(v), int(b)) for r, v, b in zip(x, y, np.zeros(len(y)) if block is None else block)]
    return columns, staged(spark.createDataFrame(rows, [*columns, "label", "block"]).repartition(4), "rows")


def test_fit_is_optimal(spark):
    rng = np.random.default_rng(1)
    n = 1500
    x = np.column_stack([np.ones(n), rng.uniform(0, 1000, n), rng.normal(size=n), rng.integers(0, 2, n)])
    y = 50 + 0.7 * x[:, 1] + 3 * x[:, 2] + (1 + x[:, 1] / 100) * rng.standard_t(3, n)
    columns, rows = table(spark, x, y)
    found = fit_quantiles(rows, columns, "label", LEVELS)
    for level in LEVELS:
        w = np.array(found[None, level])
        miss = y - x @ w
        best = loss(x, y, w, level)
        assert abs((miss < 0).mean() - level) < 0.01
        # The loss is convex: no direction from the fit leads down by more than the smoothing.
        near = np.abs(miss) < 1e-2 * y.std()
        slope = x.T @ np.where(near, 0.0, np.where(miss < 0, level - 1, level))
        assert (np.abs(slope) <= np.abs(x[near]).sum(axis=0) + 1e-9).all()
        for _ in range(200):
            step = rng.normal(size=4) * np.array([1, 0.01, 1, 1]) * 10 ** rng.uniform(-4, 1)
            assert loss(x, y, w + step, level) > best * (1 - 1e-4)


def test_groups_give_their_quantiles(spark):
    rng = np.random.default_rng(5)
    group = rng.integers(0, 3, 900)
    y = rng.normal(size=900) * (1 + group) + 10 * group
    x = np.eye(3)[group]
    columns, rows = table(spark, x, y)
    found = fit_quantiles(rows, columns, "label", LEVELS)
    for level in LEVELS:
        for g in range(3):
            assert found[None, level][g] == pytest.approx(np.quantile(y[group == g], level), abs=0.15)


def test_blocks_see_earlier_rows_only(spark):
    rng = np.random.default_rng(6)
    block = rng.integers(0, 4, 800)
    x, y = np.ones((800, 1)), rng.normal(size=800) + 2 * block
    columns, rows = table(spark, x, y, block)
    found = fit_quantiles(rows, columns, "label", [0.5], "block", range(0, 5))
    assert (0, 0.5) not in found and set(found) == {(b, 0.5) for b in range(1, 5)}
    for b in range(1, 5):
        assert found[b, 0.5][0] == pytest.approx(np.median(y[block < b]), abs=0.15)


def test_nulls_constants_and_no_rows(spark):
    rows = staged(spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (None, 1.0), (1.0, None)], "f double, label double"), "rows")
    assert fit_quantiles(rows, ["f"], "label", [0.5])[None, 0.5][0] == pytest.approx(5.0, abs=1e-3)
    assert fit_quantiles(rows.where("false"), ["f"], "label", [0.5]) == {}


def test_forecasts_are_ordered_and_blind_to_the_future(spark):
    spec = ForecastSpec(horizon=3)
    rng = np.random.default_rng(7)
    data = {k: [float(v) for v in 100 + 10 * np.sin(np.arange(80)) + rng.normal(0, 5, 80)] for k in (A, B)}
    whole = demand(spark, data)
    model = QuantileRegression(spec=spec, refit_days=40)
    scored = backtest(whole, model)
    assert scored.where("p10 > p50 or p50 > p90").isEmpty() and scored.where("p50 is not null").count() > 200
    cut = whole.select(F.date_add(F.min("EffectiveDate"), 59)).first()[0]
    earlier = backtest(whole.where(F.col("EffectiveDate") <= cut), model)
    keys = ["ProductId", "BranchId", "CountryCode", "Currency", "EffectiveDate", "ForecastDate"]
    both = {tuple(r[k] for k in keys): (r.p10, r.p50, r.p90) for r in scored.where(F.col("EffectiveDate") <= cut).collect()}
    seen = {tuple(r[k] for k in keys): (r.p10, r.p50, r.p90) for r in earlier.collect()}
    assert set(both) == set(seen)
    for k, v in seen.items():
        assert both[k] == (pytest.approx(v, abs=1e-6) if v[0] is not None else v)


def test_empty_history_gives_nulls(spark):
    history = demand(spark, {A: [1.0, 2.0]})
    assert backtest(history, QuantileRegression(spec=ForecastSpec(horizon=2))).where("p50 is not null").isEmpty()
