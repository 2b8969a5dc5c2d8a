from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.functions.normal_scores import normal_quantile
from demandspark.operators.profile import correlation_matrix, shapiro_francia


def pairwise(rows, i, j):
    both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None and r[i] == r[i] and r[j] == r[j]]
    a, b = np.array(both, float).T if both else (np.zeros(0), np.zeros(0))
    if len(a) < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
        return None
    return np.corrcoef(a, b)[0, 1]


def check(df, rows, columns):
    got = {(r.x, r.y): r["corr"] for r in correlation_matrix(df, columns).collect()}
    assert len(got) == len(columns) ** 2
    for i, x in enumerate(columns):
        for j, y in enumerate(columns):
            expected = pairwise(rows, i, j)
            assert got[x, y] == (None if expected is None else pytest.approx(expected, abs=1e-9)), (x, y)


def test_nulls_constants_and_large_means(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(500):
        z = rng.normal()
        rows.append((
            float(z), float(1e9 + z + rng.normal() * 0.01), None if rng.random() < 0.3 else float(rng.normal()),
            0.1, None, float("nan") if rng.random() < 0.2 else float(-z), int(rng.integers(0, 5)),
        ))
    columns = ["a", "far mean", "gappy", "flat", "none", "nans", "n"]
    df = spark.createDataFrame(rows, "a double, `far mean` double, gappy double, flat double, none double, nans double, n int")
    check(df.repartition(5), rows, columns)
    assert {r["corr"] for r in correlation_matrix(df.where("false"), columns[:2]).collect()} == {None}


def test_fifty_columns(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=(400, 50)) @ rng.normal(size=(50, 50))
    columns = [f"c{i}" for i in range(50)]
    df = spark.createDataFrame(values.tolist(), columns)
    got = {(r.x, r.y): r["corr"] for r in correlation_matrix(df).collect()}
    expected = np.corrcoef(values.T)
    assert all(got[f"c{i}", f"c{j}"] == pytest.approx(expected[i, j], abs=1e-9) for i in range(50) for j in range(50))


def test_no_aggregate_grows_with_the_pairs(spark):
    df = spark.range(10).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(30)])
    plan = correlation_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sum(") < 20


def francia(xs):
    xs = np.sort(np.array(xs, float))
    m = np.array([NormalDist().inv_cdf((i + 1 - 0.375) / (len(xs) + 0.25)) for i in range(len(xs))])
    return np.corrcoef(xs, m)[0, 1] ** 2 if np.ptp(xs) else None


def test_normal_quantile():
    p = np.array([1e-300, 1e-17, 1e-9, 0.01, 0.074, 0.0751, 0.3, 0.5, 0.7, 0.925, 0.9999, 1 - 1e-12])
    assert normal_quantile(p) == pytest.approx([NormalDist().inv_cdf(x) for x in p], rel=1e-12)


def test_shapiro_francia(spark, monkeypatch):
    monkeypatch.setattr("demandspark.operators.profile._RUN", 16)
    rng = np.random.default_rng(3)
    n = 700
    columns = {
        "normal": rng.normal(5, 2, n), "skewed": rng.exponential(size=n), "tied": rng.integers(0, 3, n).astype(float),
        "flat": np.full(n, 2.5), "gappy": np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n)),
    }
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], ", ".join(f"{c} double" for c in columns))
    got = {r.column: r for r in shapiro_francia(df.repartition(5), list(columns)).collect()}
    for name, values in columns.items():
        known = values[~np.isnan(values)]
        expected = francia(known)
        assert got[name].n == len(known)
        assert got[name].w == (None if expected is None else pytest.approx(expected, abs=1e-9))
    assert got["normal"].z < 1.6 < got["skewed"].z
    assert shapiro_francia(df.where("false"), list(columns)).count() == 0
