"""Reconciled forecasts: the weighted least squares solution, and levels that add up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.forecasters import TrailingQuantile
from demandspark.operators.reconcile import reconcile
from demandspark.plans.reconciled import reconciled_forecast
from demandspark.spec import ForecastSpec
from tests.helpers import A, B, C, demand

KEYS = [["p", "b", "c"], ["b", "c"], ["c"]]


def levels(spark, rows):
    """(keys..., value, variance) rows of each level."""
    schemas = ["p string, b string, c string", "b string, c string", "c string"]
    return [spark.createDataFrame(r, f"{s}, value double, variance double") for r, s in zip(rows, schemas)]


def dense(rows):
    """The same by normal equations over the lowest nodes."""
    bottom = [r for r in rows[0] if r[3] is not None]
    a, y, w = [], [], []
    for depth, level in enumerate(rows):
        for r in level:
            *keys, value, variance = r
            if value is None:
                continue
            a.append([1.0 if list(b[depth:3]) == keys else 0.0 for b in bottom])
            y.append(value)
            w.append(1 / max(variance, 1e-12))
    a, y, w = np.array(a), np.array(y), np.array(w)
    best = np.linalg.solve(a.T @ (a * w[:, None]), a.T @ (w * y))
    out = {}
    for depth in range(3):
        for b, v in zip(bottom, best):
            key = (None,) * depth + tuple(b[depth:3])
            out[depth, key] = out.get((depth, key), 0.0) + v
    return out


def nodes(seed):
    rng = np.random.default_rng(seed)
    low = [(f"p{i}", f"b{j}" if j else None, f"c{k}") for k in range(3) for j in range(3) for i in range(1 + j + k)]
    value = lambda: (float(rng.normal(10, 3)), float(rng.uniform(0.5, 4)))
    return [
        [(*n, *value()) for n in low],
        [(*n, *value()) for n in dict.fromkeys(n[1:] for n in low)],
        [(*n, *value()) for n in dict.fromkeys(n[2:] for n in low)],
    ]


@pytest.mark.parametrize("gaps", [False, True])
def test_weighted_least_squares(spark, gaps):
    rows = nodes(1)
    if gaps:  # no forecast of a branch, of a product, and of a country's own row
        rows[1][2] = (*rows[1][2][:2], None, 1.0)
        rows[0][4] = (*rows[0][4][:3], None, 1.0)
        del rows[2][1]
    found = {(r.level, (r.p, r.b, r.c)): r.reconciled for r in reconcile(levels(spark, rows), KEYS, []).collect()}
    expected = dense(rows)
    if gaps:
        assert found.pop((0, rows[0][4][:3])) is None
    assert set(found) == set(expected)
    for k, v in expected.items():
        assert found[k] == pytest.approx(v, rel=1e-9), k


def test_levels_add_up_and_a_certain_forecast_stays(spark):
    rows = nodes(2)
    rows[2][0] = ("c0", 100.0, 0.0)
    df = reconcile(levels(spark, rows), KEYS, [])
    found = {(r.level, r.p, r.b, r.c): r.reconciled for r in df.collect()}
    assert found[2, None, None, "c0"] == pytest.approx(100, abs=1e-6)
    for level, by in ((1, ["b", "c"]), (2, ["c"])):
        for r in df.where(F.col("level") == level - 1).groupBy(*by).agg(F.sum("reconciled").alias("s")).collect():
            node = (level, None, r.b if level == 1 else None, r.c)
            assert r.s == pytest.approx(found[node], rel=1e-12)


def test_empty_levels(spark):
    assert reconcile([df.where("false") for df in levels(spark, nodes(1))], KEYS, []).count() == 0


def test_plan_keeps_the_band(spark):
    history = demand(spark, {A: [5.0, 7, 9, 4, 6], B: [15.0, 11, 12, 18, 13], C: [1.0, 2, 3, 4, 5]})
    spec = ForecastSpec(horizon=2)
    rows = reconciled_forecast(history, TrailingQuantile, spec).collect()
    assert all(r.p10 <= r.p50 <= r.p90 for r in rows)
    for country in {r.CountryCode for r in rows}:
        top = [r.p50 for r in rows if r.level == 2 and r.CountryCode == country]
        low = [r.p50 for r in rows if r.level == 0 and r.CountryCode == country]
        assert sum(low) == pytest.approx(sum(top), rel=1e-12)
