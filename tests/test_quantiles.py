"""Exact quantiles against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.functions.quantiles import exact_quantiles

P = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
NAMES = [f"q{i}" for i in range(len(P))]


def groups():
    rng = np.random.default_rng(7)
    return {
        "one": [3.5],
        "two": [1.0, 2.0],
        "constant": [4.0] * 50,
        "normal": list(rng.normal(0, 1, 801)),
        "skewed": list(np.exp(rng.normal(3, 4, 700))),
        "mixed_sign": list(rng.normal(0, 1e6, 350)) + [-0.0, 0.0, 0.0],
        "tight": list(1e6 + rng.random(400) * 1e-6),
        "repeated": [1.0] * 300 + [2.0] * 300 + [9.0],
        "outlier": list(rng.random(200)) + [1e300, -1e300],
        "integers": [float(x) for x in rng.integers(-5, 5, 500)],
    }


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, float(x)) for g, values in groups().items() for x in values]
    rows += [("normal", None), ("normal", float("nan")), ("empty", None)]
    return spark.createDataFrame(rows, "g string, x double").repartition(4).cache()


def test_groups_match_numpy(frame):
    found = {r.g: r for r in exact_quantiles(frame, ["g"], "x", P, NAMES).collect()}
    assert set(found) == set(groups())
    for g, values in groups().items():
        got = [found[g][n] for n in NAMES]
        np.testing.assert_allclose(got, np.quantile(values, P), rtol=1e-12, atol=1e-12, err_msg=g)


def test_whole_table(frame):
    got = exact_quantiles(frame, [], "x", P, NAMES).first()
    values = [x for v in groups().values() for x in v]
    np.testing.assert_allclose([got[n] for n in NAMES], np.quantile(values, P), rtol=1e-12)


def test_null_keys_are_a_group(spark):
    df = spark.range(100).select(F.lit(None).cast("string").alias("g"), F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, ["g"], "x", [0.5], ["m"]).collect()[0].m == 49.5
    both = df.union(spark.createDataFrame([("a", 1.0)], "g string, x double"))
    assert {(r.g, r.m) for r in exact_quantiles(both, ["g"], "x", [0.5], ["m"]).collect()} == {
        (None, 49.5), ("a", 1.0),
    }


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_quantiles(df, ["g"], "x", [0.5], ["m"]).collect() == []
