"""Choice of the best forecaster per series without scoring every candidate everywhere.

The winners are those of ``select_candidate(candidate_errors(...))``. Two facts save the
work, and neither is a guess:

* A forecast that is the same for every day of the horizon has the squared error
  ``sum(y^2) - 2 f sum(y) + n f^2``, so such candidates are scored once an origin from sums
  over the days ahead instead of once a day.
* Squared errors only add up. Once those seen so far, spread over all days that can ever
  count, exceed the mean square of a candidate that is fully scored, the candidate cannot
  win that series any more and leaves the race for it.

The other candidates run in rounds that double the origins seen. Origins where even the best
level forecast misses come first, since errors add up fastest there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.forecasters.base import Forecaster
from demandspark.operators.grid import all_origins, origin_grid, with_horizon
from demandspark.operators.prepare import series_template
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec
from demandspark.staging import staged

# Shares of a series' origins that are scored by the end of each round.
ROUNDS = (0.125, 0.25, 0.5, 1.0)
# Rounding of the errors that are compared: a candidate leaves only beyond it.
SLACK = 1e-5


class Race(NamedTuple):
    """``winners``: candidate and rmse of each series. ``effort``: rows scored by series and candidate."""

    winners: DataFrame
    effort: DataFrame


def days_ahead(history: DataFrame, grid: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """``grid`` (series, origin) with count, sum and sum of squares of the demand in its horizon.

    Sums are of deviations from ``centre``, the mean of the series, which keeps them exact.
    One range frame along the days of a series; days that lie a whole number of steps apart
    share a frame.
    """
    known = history.where(F.col(DEMAND).isNotNull()).select(*spec.keys, DATE, F.col(DEMAND).cast("double").alias("_y"))
    series = Window.partitionBy("_group", *spec.keys)
    step = F.pmod(F.unix_date(DATE), F.lit(spec.freq_days))
    ahead = Window.partitionBy("_group", *spec.keys, step).orderBy(F.unix_date(DATE)).rangeBetween(
        spec.freq_days, spec.horizon * spec.freq_days
    )
    # Its own hash column, for the reason given in ``carry_forward``.
    rows = (
        grid.withColumn("_request", F.lit(True))
        .unionByName(known.withColumn("_request", F.lit(False)), allowMissingColumns=True)
        .withColumn("_group", F.xxhash64(*spec.keys))
        .repartition("_group")
        .withColumn("centre", F.avg("_y").over(series))
        .withColumn("_d", F.col("_y") - F.col("centre"))
    )
    sums = {"n": F.count("_d"), "s": F.sum("_d"), "ss": F.sum(F.col("_d") * F.col("_d"))}
    rows = rows.withColumns({name: c.over(ahead) for name, c in sums.items()})
    return rows.where("_request").select(*grid.columns, "centre", "n", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("s", "ss")])


def _level_errors(candidate: Forecaster, params: DataFrame, sums: DataFrame) -> DataFrame:
    """Squared error of each origin from the sums; no row a day."""
    mid = F.col(candidate.spec.quantiles.mid) - F.col("centre")
    sse = F.greatest(F.lit(0.0), F.col("ss") - 2 * mid * F.col("s") + F.col("n") * mid * mid)
    return candidate.predict(params, sums).select(
        *candidate.spec.keys, DATE, F.lit(candidate.name).alias("candidate"),
        F.when(mid.isNotNull(), F.col("n")).otherwise(F.lit(0)).alias("scored"),
        F.when(mid.isNotNull(), sse).alias("sse"),
    )


def _daily_errors(candidate: Forecaster, params: DataFrame, origins: DataFrame, history: DataFrame) -> DataFrame:
    """Sums over the horizon days of ``origins``, per series."""
    spec = candidate.spec
    actual = history.where(F.col(DEMAND).isNotNull()).select(
        *spec.keys, F.col(DATE).alias(TARGET_DATE), F.col(DEMAND).cast("double").alias("_actual")
    )
    # Days without demand never count, so nothing is forecast for them.
    requests = with_horizon(origins, spec).join(actual.hint("merge"), [*spec.keys, TARGET_DATE])
    miss = F.col("_actual") - F.col(spec.quantiles.mid)
    return (
        candidate.predict(params, requests).groupBy(*spec.keys)
        .agg(F.count(miss).alias("scored"), F.sum(miss * miss).alias("sse"), F.count("*").alias("rows"))
        .withColumn("candidate", F.lit(candidate.name))
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rmse(sse: Column, scored: Column) -> Column:
    return F.round(F.sqrt(F.try_divide(sse, scored)), 6)


def candidate_race(
    history: DataFrame, candidates: Sequence[Forecaster], rounds: Sequence[float] = ROUNDS
) -> Race:
    """Winner of each series over all origins and days; ties go to the first name.

    All candidates share one spec and have names of their own. A series that nobody can be
    scored on has a null candidate. Demand is one row per series and day; null demand counts
    for nobody.
    """
    spec, keys = candidates[0].spec, list(candidates[0].spec.keys)
    if any(c.spec != spec for c in candidates) or len({c.name for c in candidates}) < len(candidates):
        raise ValueError("candidates of a race share one spec and have different names")
    level = [c for c in candidates if not c.needs_target]
    daily = {c.name: c for c in candidates if c.needs_target}

    template = series_template(history, keys)
    sums = staged(days_ahead(history, origin_grid(template, all_origins(history)), spec), "days-ahead")
    at_origin = staged(_union([_level_errors(c, c.fit(history), sums) for c in level]), "level-errors") if level else None
    done, hard = [], F.col("ss")
    ranked = sums.where("n > 0").select(*keys, DATE, "n", "ss")
    if at_origin is not None:
        # Cheapest miss at an origin; where no level forecast exists yet, the spread itself.
        best = at_origin.groupBy(*keys, DATE).agg(F.min("sse").alias("_least"))
        ranked = ranked.join(best, [*keys, DATE], "left")
        hard = F.coalesce("_least", "ss")
        done.append(
            at_origin.groupBy(*keys, "candidate").agg(F.sum("scored").alias("scored"), F.sum("sse").alias("sse"), F.count("*").alias("rows"))
        )
    if not daily:
        return _finish(template, staged(_union(done), "race"), spec)

    order = Window.partitionBy(*keys).orderBy(hard.desc(), DATE)
    share = F.row_number().over(order) / F.count("*").over(Window.partitionBy(*keys))
    number = sum([(share > r).cast("int") for r in rounds[:-1]], F.lit(0))
    ranked = staged(ranked.select(*keys, DATE, "n", number.alias("round")), "race-origins")
    possible = staged(ranked.groupBy(*keys, "round").agg(F.sum("n").alias("left")), "race-days")
    params = {name: staged(c.fit(history), f"race-{name}") for name, c in daily.items()}

    def score(name: str, runners: DataFrame, first: int, last: int) -> DataFrame:
        chosen = ranked.where(F.col("round").between(first, last)).select(*keys, DATE)
        mine = runners.where(F.col("candidate") == name).select(*keys)
        return _daily_errors(daily[name], params[name], chosen.join(mine, keys, "left_semi"), history)

    # As many rows a series as there are candidates.
    runners = template.withColumn("candidate", F.explode(F.array(*[F.lit(n) for n in daily])))
    seen = staged(_union([score(n, runners, 0, 0) for n in daily]), "round-0")
    # The most promising of them runs to the end at once, if it is ahead of the level forecasts:
    # its mean square is a bar for the others.
    mean_square = F.try_divide(F.col("sse"), F.col("scored"))
    first = F.min(F.when(mean_square.isNotNull(), F.struct(mean_square.alias("ms"), "candidate")))
    leaders = seen.groupBy(*keys).agg(first.alias("b"))
    if done:
        leaders = leaders.join(_bar(done, keys), keys, "left").where("b.ms <= coalesce(bar * bar, b.ms)")
    leaders = staged(leaders.select(*keys, F.col("b.candidate").alias("candidate")), "leaders")
    last = len(rounds) - 1
    if last:
        rest = _union([score(n, leaders, 1, last) for n in daily])
        finished = staged(_add(seen.join(leaders, [*keys, "candidate"], "left_semi"), rest, keys), "leaders-done")
        runners = runners.join(leaders, [*keys, "candidate"], "left_anti")
        seen = seen.join(leaders, [*keys, "candidate"], "left_anti")
        done.append(finished)
    bar = _bar(done, keys) if done else template.withColumn("bar", F.lit(None).cast("double"))
    out = []
    for number in range(1, last + 1):
        left = possible.where(F.col("round") >= number).groupBy(*keys).agg(F.sum("left").alias("left"))
        judged = (
            runners.join(seen, [*keys, "candidate"], "left").join(left, keys, "left").join(bar, keys, "left")
            .select(*keys, "candidate", "scored", "sse", "rows", "bar",
                    F.sqrt(F.try_divide(F.col("sse"), F.col("scored") + F.coalesce("left", F.lit(0)))).alias("least"))
        )
        judged = staged(
            judged.withColumn("out", F.coalesce(F.col("least") > F.col("bar") * (1 + SLACK) + SLACK, F.lit(False))), "judged"
        )
        sofar = ["scored", "sse", "rows"]
        out.append(judged.where("out").select(*keys, "candidate", *sofar))
        runners = judged.where("not out").select(*keys, "candidate")
        more = _union([score(n, runners, number, number) for n in daily])
        seen = staged(_add(judged.where("not out").select(*keys, "candidate", *sofar), more, keys), f"round-{number}")
    done.append(seen)
    return _finish(template, staged(_union(done), "race"), spec, _union(out) if out else None)


def _add(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("scored", "sse", "rows")]
    return staged(a.unionByName(b), "parts").groupBy(*keys, "candidate").agg(*sums)


def _bar(done: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Lowest error of the candidates that are fully scored; no later one may lie above it."""
    rmse = F.sqrt(F.try_divide(F.col("sse"), F.col("scored")))
    return staged(_union(done).groupBy(*keys).agg(F.min(rmse).alias("bar")), "bar")


def _finish(template: DataFrame, done: DataFrame, spec: ForecastSpec, out: DataFrame | None = None) -> Race:
    keys = list(spec.keys)
    rmse = _rmse(F.col("sse"), F.col("scored"))
    best = F.min(F.when(rmse.isNotNull(), F.struct(rmse.alias("rmse"), "candidate")))
    winners = (
        template.join(done.groupBy(*keys).agg(best.alias("b")), keys, "left")
        .select(*keys, F.col("b.candidate").alias("candidate"), F.col("b.rmse").alias("rmse"))
    )
    effort = done if out is None else done.unionByName(out)
    return Race(winners, effort.select(*keys, "candidate", F.coalesce("rows", F.lit(0)).alias("rows")))
