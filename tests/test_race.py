"""The race has the winners of the full search and scores fewer rows."""

import pytest
from pyspark.sql import functions as F

from demandspark.forecasters import (
    ExponentialSmoothing, SeasonalNaive, TrailingQuantile, WeekdayQuantile, candidate_errors, select_candidate,
)
from demandspark.forecasters.race import candidate_race, days_ahead
from demandspark.operators.grid import all_origins, origin_grid
from demandspark.operators.prepare import series_template
from demandspark.spec import ForecastSpec
from tests.helpers import A, B, C, DEMAND_SCHEMA, day, demand, rows

SPEC = ForecastSpec(horizon=7, trailing_rows=5, weekday_weeks=3)


def candidates(spec=SPEC):
    return [SeasonalNaive(spec), TrailingQuantile(spec), WeekdayQuantile(spec), ExponentialSmoothing(0.3, spec)]


@pytest.fixture(scope="module")
def history(spark):
    weekly = [100 + 50 * (i % 7) + i % 3 for i in range(60)]
    level = [500 + (i * 7919 % 13) for i in range(50)]
    return demand(spark, {A: weekly, B: [..., ..., *level], C: [5, 9, None, 7, ..., 4, 8]})


def test_winners_of_the_full_search_for_half_the_rows(history):
    full = select_candidate(candidate_errors(history, candidates()), SPEC)
    race = candidate_race(history, candidates())
    columns = ["ProductId", "CountryCode", "candidate", "rmse"]
    for got, want in zip(rows(race.winners, *columns), rows(full, *columns), strict=True):
        assert got[:3] == want[:3] and got[3] == pytest.approx(want[3], abs=2e-6)
    assert race.winners.select("candidate").distinct().count() > 1
    every = origin_grid(series_template(history, SPEC.keys), all_origins(history)).count() * SPEC.horizon * 4
    assert race.effort.agg(F.sum("rows")).first()[0] <= every / 2


def test_level_candidates_alone_and_daily_ones_alone(history):
    for chosen in (candidates()[1:2], [candidates()[0], candidates()[2]], candidates()[:1]):
        full = select_candidate(candidate_errors(history, chosen), SPEC)
        got = candidate_race(history, chosen).winners
        for a, b in zip(rows(got, "ProductId", "CountryCode", "candidate", "rmse"),
                        rows(full, "ProductId", "CountryCode", "candidate", "rmse"), strict=True):
            assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=2e-6)


def test_days_ahead_counts_whole_steps(spark):
    history = demand(spark, {A: [1, 2, 4, 8, 16, ..., 64]})
    grid = origin_grid(series_template(history), all_origins(history))
    got = {r["EffectiveDate"]: r for r in days_ahead(history, grid, ForecastSpec(horizon=2, freq_days=2)).collect()}
    centre = 95 / 6
    assert got[day(0)]["n"] == 2 and got[day(0)]["s"] == pytest.approx(4 + 16 - 2 * centre)
    assert got[day(1)]["n"] == 1 and got[day(1)]["ss"] == pytest.approx((8 - centre) ** 2)
    assert (got[day(6)]["n"], got[day(6)]["s"], got[day(6)]["ss"]) == (0, 0.0, 0.0)


def test_one_day_has_no_winner_and_no_rows_no_series(spark):
    lone = demand(spark, {A: [3]})
    assert [tuple(r) for r in candidate_race(lone, candidates()).winners.collect()] == [(*A, None, None)]
    empty = spark.createDataFrame([], DEMAND_SCHEMA)
    assert candidate_race(empty, candidates()).winners.isEmpty()


def test_names_must_differ(history):
    with pytest.raises(ValueError, match="different names"):
        candidate_race(history, [TrailingQuantile(SPEC), TrailingQuantile(SPEC)])
