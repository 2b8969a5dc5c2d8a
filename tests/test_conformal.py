"""Widened bands against a plain recursion, and their coverage."""

import numpy as np
import pytest

from demandspark.forecasters import TrailingQuantile, backtest
from demandspark.forecasters.conformal import widened_bands
from demandspark.functions.chains import alike
from demandspark.spec import ForecastSpec
from tests.helpers import A, B, C, day, demand

SPEC = ForecastSpec(horizon=3, trailing_rows=8)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    level = 100 + np.cumsum(rng.normal(0, 4, 400))  # a wandering level: the plain band covers too little
    return {A: [round(float(v), 3) for v in level], B: [..., *[float(v) for v in rng.integers(1, 9, 40)], None, ..., 3.0], C: [2.0]}


@pytest.fixture(scope="module")
def forecasts(spark, data):
    history = demand(spark, data)
    return history, backtest(history, TrailingQuantile(SPEC))


def test_bands_are_those_of_the_recursion(data, forecasts):
    history, plain = forecasts
    actual = {(k[0], k[2], day(i)): v for k, s in data.items() for i, v in enumerate(s) if v is not ... and v is not None}
    chains = {}
    for r in plain.collect():
        lead = (r["ForecastDate"] - r["EffectiveDate"]).days
        chains.setdefault((r["ProductId"], r["CountryCode"], lead), []).append(r)
    want = {}
    for (product, country, lead), rows in chains.items():
        rows.sort(key=lambda r: r["ForecastDate"])
        states, total, seen = [0.0], 0.0, 0
        for r in rows:
            used = states[sum(x["ForecastDate"] <= r["EffectiveDate"] for x in rows)]
            y = actual.get((product, country, r["ForecastDate"]))
            state = states[-1]
            if y is not None and r["p10"] is not None:
                total, seen = total + abs(y - r["p50"]), seen + 1
                outside = max(r["p10"] - y, y - r["p90"]) > used
                state += 0.25 * total / seen * (outside - 0.2)
            states.append(state)
            key = product, country, r["EffectiveDate"], r["ForecastDate"]
            want[key] = None if r["p10"] is None else (min(r["p10"] - used, r["p50"]), max(r["p90"] + used, r["p50"]))
    got = widened_bands(plain, history, 0.8, SPEC).collect()
    assert len(got) == len(want)
    for r in got:
        expected = want[r["ProductId"], r["CountryCode"], r["EffectiveDate"], r["ForecastDate"]]
        assert (r["p10"], r["p90"]) == ((None, None) if expected is None else pytest.approx(expected))


def test_coverage_is_the_wanted_one(data, forecasts):
    history, plain = forecasts
    series = dict(enumerate(data[A]))

    def covered(bands):
        rows = [r for r in bands.where("ProductId = '18' and CountryCode = 'ZM'").collect() if r["p10"] is not None]
        hits = [r["p10"] <= series[d] <= r["p90"] for r in rows if (d := (r["ForecastDate"] - day(0)).days) in series]
        return np.mean(hits)

    assert covered(plain) < 0.75
    assert abs(covered(widened_bands(plain, history, 0.8, SPEC)) - 0.8) < 0.02


def test_no_forecasts_no_bands(forecasts):
    history, plain = forecasts
    assert widened_bands(plain.limit(0), history, 0.8, SPEC).isEmpty()


def test_chains_of_like_length_share_a_matrix():
    lengths = [5, 1, 900, 3, 3, 40, 7, 900]
    parts = list(alike(lengths, cells=100))
    assert sorted(i for p in parts for i in p) == list(range(len(lengths)))
    for p in parts:
        assert len(p) == 1 or len(p) * max(lengths[i] for i in p) <= 100
