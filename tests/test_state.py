"""Series states: advanced by new rows they equal those of all rows, and old rows are not read."""

import random

import pytest
from pyspark.sql import functions as F

from demandspark.forecasters import ExponentialSmoothing, TrailingQuantile
from demandspark.forecasters.state import advance, forecast_states, merge_states, state_of
from demandspark.spec import ForecastSpec
from tests.helpers import A, B, C, demand

SPEC = ForecastSpec(trailing_rows=5)


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(4)
    value = lambda i: ... if rng.random() < 0.2 else 100 + 10 * rng.random()
    return demand(spark, {A: [value(i) for i in range(60)], B: [..., ..., 5.0, 7.0, ..., 6.0], C: [1e9 + rng.random() for _ in range(12)]})


def rows(state):
    return {(r.ProductId, r.BranchId, r.CountryCode, r.Currency): r for r in state.collect()}


def same(a, b):
    a, b = rows(a), rows(b)
    assert set(a) == set(b)
    for k in a:
        assert a[k].last == b[k].last and a[k].recent == b[k].recent
        assert a[k].weight == pytest.approx(b[k].weight, rel=1e-12) and a[k]["mean"] == pytest.approx(b[k]["mean"], rel=1e-12)
        assert a[k].moment == pytest.approx(b[k].moment, rel=1e-6, abs=1e-3 if a[k]["mean"] > 1e8 else 1e-9)


@pytest.mark.parametrize("rule", ["early", "late", "mixed"])
def test_advanced_states_equal_those_of_all_rows(history, rule):
    position = F.dayofyear("EffectiveDate")
    first = {"early": position < 20, "late": position > 40, "mixed": position % 3 == 0}[rule]
    old, new = history.where(first), history.where(~first)
    same(advance(state_of(old, SPEC), new, SPEC), state_of(history, SPEC))


def test_merging_needs_no_order(history):
    parts = [state_of(history.where(F.pmod(F.dayofyear("EffectiveDate"), F.lit(3)) == i), SPEC) for i in range(3)]
    a, b, c = parts
    same(merge_states(merge_states(a, b, SPEC), c, SPEC), merge_states(b, merge_states(c, a, SPEC), SPEC))
    same(merge_states(a, a.where("false"), SPEC), a)


def test_forecasts_equal_those_of_the_forecasters(history):
    got = {(r.method, r.ProductId, r.BranchId): r for r in forecast_states(state_of(history, SPEC, 0.4), SPEC).collect()}
    last = history.groupBy(*SPEC.keys).agg(F.max("EffectiveDate").alias("EffectiveDate"))
    for model in (TrailingQuantile(SPEC), ExponentialSmoothing(0.4, SPEC)):
        for r in model.predict(model.fit(history), last).collect():
            mine = got[model.name, r.ProductId, r.BranchId]
            assert mine.EffectiveDate == r.EffectiveDate
            assert (mine.p10, mine.p50, mine.p90) == pytest.approx((r.p10, r.p50, r.p90), rel=1e-6)


def test_old_history_is_not_read(spark, history, tmp_path):
    cut = F.dayofyear("EffectiveDate") < 40
    history.where(cut).write.parquet(f"{tmp_path}/old")
    history.where(~cut).write.parquet(f"{tmp_path}/new")
    state_of(spark.read.parquet(f"{tmp_path}/old"), SPEC).write.parquet(f"{tmp_path}/state")
    advanced = advance(spark.read.parquet(f"{tmp_path}/state"), spark.read.parquet(f"{tmp_path}/new"), SPEC)
    assert {p.split("/")[-2] for p in advanced.inputFiles()} == {"state", "new"}
    same(advanced, state_of(history, SPEC))


def test_no_rows(history):
    assert state_of(history.where("false"), SPEC).count() == 0
    same(advance(state_of(history, SPEC), history.where("false"), SPEC), state_of(history, SPEC))
