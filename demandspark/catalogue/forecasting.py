"""Forecasters, selection, model reuse and forecast tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import (
    K, KEYS, SPEC, demand_daily, evaluation, events_daily, sql, weekday_backtest,
)
from demandspark.catalogue.registry import query, rounded
from demandspark.forecasters import (
    ExponentialSmoothing, LagRegression, SeasonalNaive, TrailingQuantile, WeekdayQuantile, backtest,
    candidate_errors, iterative_forecast, select_candidate,
)
from demandspark.forecasters.iterative import point_forecast_column
from demandspark.forecasters.race import candidate_race
from demandspark.operators.evaluate import holdout_accuracy
from demandspark.operators.grid import (
    all_origins, latest_origin, origin_grid, step_grid, with_forecast_day, with_horizon,
)
from demandspark.operators.prepare import series_template, train_future_split
from demandspark.operators.reshape import (
    forecast_band, forecast_long, history_with_forecasts, pivot_forecast, step_join,
)
from demandspark.plans.backtesting import train_and_backtest
from demandspark.plans.logged import logged_forecast
from demandspark.plans.scaled import scaled_forecast
from demandspark.spec import DATE, DEMAND, FORECAST_STEP, TARGET_DATE, ForecastSpec
from demandspark.staging import staged, staging_path

Q = SPEC.quantiles.names
ROUND_Q = ", ".join(f"round({q}, 4) as {q}" for q in Q)
ON = " and ".join(f"g.{k} = h.{k}" for k in KEYS)
GK = ", ".join("g." + k for k in KEYS)
WEEKDAY_FORECASTS = sql("ed ed_grid wq", f"select {K}, EffectiveDate, ForecastDate, {ROUND_Q} from wq")


@query("weekday_quantile", WEEKDAY_FORECASTS)
def _(spark, sf):
    return rounded(weekday_backtest(spark, sf), 4).select(*KEYS, DATE, TARGET_DATE, *Q)


@query("model_reuse", WEEKDAY_FORECASTS)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    model = WeekdayQuantile(SPEC)
    path = staging_path(spark, "model")
    model.fit(ed).write.parquet(path)
    grid = with_horizon(origin_grid(series_template(ed), all_origins(ed)), SPEC)
    return rounded(model.predict(spark.read.parquet(path), grid), 4)


RESIDUALS = f"""select {K}, dayname(EffectiveDate) as wd, EffectiveDate, Demand,
    Demand - lag(Demand) over (partition by {K}, dayname(EffectiveDate) order by EffectiveDate) as r from ed"""
NAIVE_STATES = f"""select {K}, wd, EffectiveDate, Demand as p50,
    Demand + quantile_cont(r, 0.1) over w as p10, Demand + quantile_cont(r, 0.9) over w as p90
    from r window w as (partition by {K}, wd order by EffectiveDate rows between 7 preceding and current row)"""
NAIVE = f"""select {GK}, g.EffectiveDate, g.ForecastDate, h.p10, h.p50, h.p90
    from (select *, dayname(ForecastDate) as wd from ed_grid) g asof left join s h
    on {ON} and g.wd = h.wd and g.EffectiveDate >= h.EffectiveDate"""


@query(
    "seasonal_naive",
    sql("ed ed_grid", f"select {K}, EffectiveDate, ForecastDate, {ROUND_Q} from n", r=RESIDUALS, s=NAIVE_STATES, n=NAIVE),
)
def _(spark, sf):
    return rounded(backtest(staged(events_daily(spark, sf), "history"), SeasonalNaive(SPEC)), 4)


TRAILING_STATES = f"""select {K}, EffectiveDate, quantile_cont(Demand, 0.1) over w as p10,
    quantile_cont(Demand, 0.5) over w as p50, quantile_cont(Demand, 0.9) over w as p90
    from ed window w as (partition by {K} order by EffectiveDate rows between 27 preceding and current row)"""
TRAILING = f"""select {GK}, g.EffectiveDate, g.ForecastDate, h.p10, h.p50, h.p90
    from ed_grid g asof left join ts h on {ON} and g.EffectiveDate >= h.EffectiveDate"""


@query(
    "trailing_forecast",
    sql("ed ed_grid", f"select {K}, EffectiveDate, ForecastDate, {ROUND_Q} from t", ts=TRAILING_STATES, t=TRAILING),
)
def _(spark, sf):
    return rounded(backtest(staged(events_daily(spark, sf), "history"), TrailingQuantile(SPEC)), 4)


ALPHA = 0.3
Z90 = 1.2815515655446004
# Moments about the series mean, which keeps the variance exact.
SMOOTHED = f"""select {GK}, g.EffectiveDate, any_value(mu) + sum(w * d) / sum(w) as lvl,
    sqrt(greatest(0.0::double, sum(w * d * d) / sum(w) - power(sum(w * d) / sum(w), 2))) as spr
    from (select *, avg(Demand) over (partition by {K}) as mu from ed) g
    join (select *, Demand - avg(Demand) over (partition by {K}) as d from ed) h
    on {ON} and h.EffectiveDate <= g.EffectiveDate
    cross join lateral (select power(0.7::double, g.EffectiveDate - h.EffectiveDate) as w)
    group by {GK}, g.EffectiveDate"""
SMOOTH = f"""select {GK}, g.EffectiveDate, g.ForecastDate, lvl - {Z90}::double * spr as p10, lvl as p50,
    lvl + {Z90}::double * spr as p90
    from ed_grid g asof left join sm h on {ON} and g.EffectiveDate >= h.EffectiveDate"""


def _rmse(table: str, name: str) -> str:
    return f"""select {GK}, '{name}' as candidate, round(sqrt(avg(power(h.Demand - g.p50, 2))), 6) as rmse,
        count(h.Demand - g.p50) as n_scored
        from {table} g left join ed h on {ON} and g.ForecastDate = h.EffectiveDate group by {GK}"""


ERRORS = dict(
    r=RESIDUALS, s=NAIVE_STATES, n=NAIVE, ts=TRAILING_STATES, t=TRAILING, sm=SMOOTHED, es=SMOOTH,
    e=" union all ".join(
        [_rmse("n", "seasonal_naive"), _rmse("t", "trailing_quantile"), _rmse("wq", "weekday_quantile"),
         _rmse("es", "exp_smoothing")]
    ),
)
CANDIDATES = [SeasonalNaive(SPEC), TrailingQuantile(SPEC), WeekdayQuantile(SPEC), ExponentialSmoothing(ALPHA, SPEC)]


@query("candidate_errors", sql("ed ed_grid wq", f"select {K}, candidate, round(rmse, 4) as rmse, n_scored from e", **ERRORS))
def _(spark, sf):
    return rounded(candidate_errors(staged(events_daily(spark, sf), "history"), CANDIDATES), 4)


@query(
    "candidate_selection",
    sql("ed ed_grid wq", f"""select {K}, candidate, round(rmse, 4) as rmse from e where rmse is not null
        qualify row_number() over (partition by {K} order by rmse, candidate) = 1""", **ERRORS),
)
def _(spark, sf):
    return rounded(select_candidate(candidate_errors(staged(events_daily(spark, sf), "history"), CANDIDATES), SPEC), 4)


@query(
    "candidate_race",
    sql("ed ed_grid wq", f"""select {K}, candidate, round(rmse, 4) as rmse from e where rmse is not null
        qualify row_number() over (partition by {K} order by rmse, candidate) = 1""", **ERRORS),
)
def _(spark, sf):
    return rounded(candidate_race(staged(events_daily(spark, sf), "history"), CANDIDATES).winners, 4)


@query(
    "forecast_long",
    sql("ed ed_grid wq fl", f"select {K}, EffectiveDate, ForecastDate, {ROUND_Q}, ForecastDay from fl"),
)
def _(spark, sf):
    return rounded(forecast_long(weekday_backtest(spark, sf), SPEC), 4)


ZERO_BASED = ForecastSpec(day_offset=0)


@query(
    "forecast_long_zero_based",
    sql("ed ed_grid wq", f"""select {K}, EffectiveDate, ForecastDate, {ROUND_Q},
        cast(ForecastDate - EffectiveDate as integer) as ForecastDay from wq"""),
)
def _(spark, sf):
    return rounded(forecast_long(weekday_backtest(spark, sf), ZERO_BASED), 4)


def _cells(days) -> str:
    return ", ".join(
        f"round(avg({q}) filter (where ForecastDay = {d}), 4) as {q}_Day{d}" for q in Q for d in days
    )


WIDE = f"select {K}, EffectiveDate, {_cells(range(2, 11))} from fl group by {K}, EffectiveDate"


@query("forecast_wide", sql("ed ed_grid wq fl", WIDE))
def _(spark, sf):
    return rounded(pivot_forecast(forecast_long(weekday_backtest(spark, sf), SPEC), SPEC), 4)


POINT_KEYS = {"ProductId": "click", "BranchId": "3", "CountryCode": "ZM", "Currency": "USD"}
POINT_ORIGIN = "2024-01-20"


@query(
    "point_forecast",
    sql("ed ed_grid wq", f"""select {K}, EffectiveDate, {_cells(range(2, 12))} from (
        select *, cast(ForecastDate - EffectiveDate + 1 as integer) as ForecastDay from wq
        where {' and '.join(f"{k} = '{v}'" for k, v in POINT_KEYS.items())}
        and EffectiveDate = date '{POINT_ORIGIN}') group by {K}, EffectiveDate"""),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    wanted = series_template(ed)
    for key, value in POINT_KEYS.items():
        wanted = wanted.where(F.col(key) == value)
        ed = ed.where(F.col(key) == value)
    origin = wanted.select("CountryCode", F.lit(POINT_ORIGIN).cast("date").alias(DATE))
    model = WeekdayQuantile(SPEC)
    scored = model.predict(model.fit(ed), with_horizon(origin_grid(wanted, origin), SPEC))
    return rounded(pivot_forecast(with_forecast_day(scored, SPEC), SPEC, range(2, SPEC.horizon + 2)), 4)


@query(
    "history_with_wide",
    sql("ed ed_grid wq fl", f"""select g.*, {', '.join(f'{q}_Day{d}' for q in Q for d in range(2, 11))}
        from ed g left join wide h on {ON} and g.EffectiveDate = h.EffectiveDate""", wide=WIDE),
)
def _(spark, sf):
    wide = pivot_forecast(forecast_long(weekday_backtest(spark, sf), SPEC), SPEC)
    return rounded(history_with_forecasts(events_daily(spark, sf), wide, SPEC), 4)


@query(
    "train_backtest",
    sql("ed ed_grid wq fl", f"""select g.*, dayname(g.EffectiveDate) as DayOfWeekName, 'Zambia' as CountryName,
        {', '.join(f'{q}_Day{d}' for q in Q for d in range(2, 11))}
        from ed g left join wide h on {ON} and g.EffectiveDate = h.EffectiveDate""", wide=WIDE),
)
def _(spark, sf):
    return rounded(train_and_backtest(events_daily(spark, sf), WeekdayQuantile(SPEC)), 4)


@query(
    "history_with_long",
    sql("ed ed_grid wq fl", f"""select g.*, ForecastDate, {ROUND_Q}, ForecastDay
        from ed g left join fl h on {ON} and g.EffectiveDate = h.EffectiveDate"""),
)
def _(spark, sf):
    long = forecast_long(weekday_backtest(spark, sf), SPEC)
    return rounded(history_with_forecasts(events_daily(spark, sf), long, SPEC), 4)


@query(
    "evaluation_table",
    sql("ed ed_grid wq ev", f"select {K}, EffectiveDate, round(Demand, 4) as Demand, {ROUND_Q}, ForecastStep from ev"),
)
def _(spark, sf):
    return rounded(evaluation(spark, sf), 4)


@query(
    "forecast_band",
    sql("ed ed_grid wq ev", f"""select {K}, EffectiveDate, ForecastStep, {ROUND_Q},
        round(Demand, 4) as Actual from ev order by {K}, EffectiveDate, ForecastStep"""),
)
def _(spark, sf):
    band = rounded(forecast_band(evaluation(spark, sf), SPEC), 4)
    return band.orderBy(*KEYS, DATE, FORECAST_STEP)


TRAIN = f"""select * from ed where EffectiveDate <= (select max(EffectiveDate) - 10 from ed)"""
STEPS_SPEC = ForecastSpec(iterative_steps=10)


def recursion(source: str, steps: int) -> dict[str, str]:
    """One row per series and step; the tail is carried as a list."""
    def level(p):
        return f"list_aggregate(tail, 'quantile_cont', {p})"

    return {
        "tails": f"""select {K}, list(Demand order by EffectiveDate) as tail from (
            select *, row_number() over (partition by {K} order by EffectiveDate desc) as back from {source})
            where back <= 28 group by {K}""",
        "steps": f"""select {K}, 1 as step, tail from tails
            union all
            select {K}, step + 1, (list_append(tail, {level(0.5)}))[greatest(1, len(tail) - 26):]
            from steps where step < {steps}""",
        "iter": f"""select {K}, cast(last + step as date) as EffectiveDate, cast(step as integer) as ForecastStep,
            {', '.join(f'{level(p)} as {q}' for q, p in SPEC.quantiles.levels)}
            from steps join (select CountryCode, max(EffectiveDate) as last from {source} group by 1) using (CountryCode)""",
    }


def _train(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    return train_future_split(ed, 10)


@query(
    "iterative_forecast",
    sql("ed", f"select {K}, EffectiveDate, ForecastStep, {ROUND_Q} from iter", recursive=True, train=TRAIN, **recursion("train", 10)),
)
def _(spark, sf):
    train = _train(spark, sf).where("part = 'train'")
    return rounded(iterative_forecast(train, STEPS_SPEC), 4)


@query(
    "step_join",
    sql("ed", f"select {K}, EffectiveDate, round(p50, 4) as Demand from iter where ForecastStep = 1",
        recursive=True, train=TRAIN, **recursion("train", 1)),
)
def _(spark, sf):
    train = _train(spark, sf).where("part = 'train'").select(*KEYS, DATE, DEMAND)
    requests = step_grid(series_template(train), latest_origin(train))
    points = point_forecast_column(iterative_forecast(train, ForecastSpec(iterative_steps=1)))
    return rounded(step_join(requests, points, SPEC), 4).select(*KEYS, DATE, DEMAND)


@query(
    "holdout_accuracy",
    sql("ed", f"""select {GK}, round(avg(abs(g.Demand - p50) / nullif(g.Demand, 0)) * 100, 4) as mape,
        round(avg(abs(g.Demand - p50) / nullif(abs(g.Demand), 0)) * 100, 4) as mape_abs,
        round(avg(case when g.Demand between p10 and p90 then 1.0 else 0.0 end) * 100, 4) as coverage,
        round(sqrt(avg(power(g.Demand - p50, 2))), 4) as rmse, count(*) as n_rows,
        count(g.Demand - p50) as n_scored, count(*) filter (where g.Demand = 0) as n_zero_demand
        from (select * from ed where EffectiveDate > (select max(EffectiveDate) - 10 from ed)) g
        left join iter h on {ON} and g.EffectiveDate = h.EffectiveDate group by {GK}""",
        recursive=True, train=TRAIN, **recursion("train", 10)),
)
def _(spark, sf):
    split = staged(_train(spark, sf), "split")
    forecasts = iterative_forecast(split.where("part = 'train'"), STEPS_SPEC)
    return rounded(holdout_accuracy(split.where("part = 'future'"), forecasts, SPEC), 4)


@query(
    "exp_smoothing",
    sql("ed ed_grid", f"""select {K}, EffectiveDate, ForecastDate, {', '.join(f'round({q}, 3) as {q}' for q in Q)}
        from es""", sm=SMOOTHED, es=SMOOTH),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    scored = backtest(ed, ExponentialSmoothing(ALPHA, SPEC))
    return rounded(scored, 3).select(*KEYS, DATE, TARGET_DATE, *Q)


HOLIDAY = "2024-01-01"
# Features of (series, origin, target) rows: the latest demand, and the latest on the target's weekday.
LAGGED = """select g.*, coalesce(wk.Demand, dy.Demand) as lag_week, dy.Demand as lag_day,
    cast(g.ForecastDate - g.EffectiveDate as double) as lead, case when g.ForecastDate = date '{holiday}' then 1.0::double else 0 end as holiday
    from (select *, dayname(ForecastDate) as wd from {source}) g
    asof left join ed dy on {dy} and g.EffectiveDate >= dy.EffectiveDate
    asof left join (select *, dayname(EffectiveDate) as wd from ed) wk on {wk} and g.wd = wk.wd and g.EffectiveDate >= wk.EffectiveDate"""


def _lagged(source: str) -> str:
    on = lambda t: " and ".join(f"g.{k} = {t}.{k}" for k in KEYS)
    return LAGGED.format(holiday=HOLIDAY, source=source, dy=on("dy"), wk=on("wk"))


def _holidays(spark):
    return spark.createDataFrame([("ZM", HOLIDAY, "New Year")], "CountryCode string, date string, holiday string").withColumn(
        "date", F.col("date").cast("date")
    )


@query(
    "lag_features",
    sql("ed ed_grid", f"""select {K}, EffectiveDate, ForecastDate, round(lag_day, 4) as lag_day, round(lag_week, 4) as lag_week,
        lead, holiday, case when wd = 'Monday' then 1.0::double else 0 end as "is_Monday" from l""", l=_lagged("ed_grid")),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    grid = with_horizon(origin_grid(series_template(ed), all_origins(ed)), SPEC)
    rows = LagRegression(_holidays(spark), SPEC).with_features(grid, ed)
    return rounded(rows, 4).select(*KEYS, DATE, TARGET_DATE, "lag_day", "lag_week", "lead", "holiday", "is_Monday")


@query(
    "lag_scoring",
    sql("ed ed_grid", f"""select {GK}, g.EffectiveDate, g.ForecastDate,
        {', '.join(f'round(0.5 * (lag_day + lag_week) + coalesce(h.{q}, 0), 4) as {q}' for q in Q)}
        from l g asof left join misses h on {ON} and g.lead = h.lead and g.EffectiveDate >= h.EffectiveDate""",
        seen=f"""select {K}, cast(EffectiveDate - cast(j as integer) as date) as EffectiveDate, EffectiveDate as ForecastDate,
            Demand as label from ed cross join range(1, {SPEC.horizon + 1}) r(j)""",
        trained=_lagged("seen"), l=_lagged("ed_grid"),
        misses=f"""select {K}, lead, ForecastDate as EffectiveDate,
            {', '.join(f'quantile_cont(label - 0.5 * (lag_day + lag_week), {p}) over w as {q}' for q, p in SPEC.quantiles.levels)}
            from trained where lag_day is not null
            window w as (partition by {K}, lead order by ForecastDate rows between {SPEC.trailing_rows - 1} preceding and current row)"""),
)
def _(spark, sf):
    """The regression with its weights held at the mean of the two lags."""
    model = LagRegression(_holidays(spark), SPEC, ridge=None)
    return rounded(backtest(staged(events_daily(spark, sf), "history"), model), 4).select(*KEYS, DATE, TARGET_DATE, *Q)


@query("lag_regression")
def _(spark, sf):
    return rounded(backtest(staged(events_daily(spark, sf), "history"), LagRegression(_holidays(spark), SPEC)), 4)


SCALED_STATES = f"""select {K}, EffectiveDate, quantile_cont(z, 0.1) over w as p10,
    quantile_cont(z, 0.5) over w as p50, quantile_cont(z, 0.9) over w as p90
    from (select *, (Demand - mean) / (case when std = 0 then 1 else std end) as z
          from dd join params_dd using (CountryCode, Currency, BranchId))
    window w as (partition by {K} order by EffectiveDate rows between 27 preceding and current row)"""
LAST_ORIGIN = f"""select {K}, last as EffectiveDate from (select distinct {K} from dd)
    join (select CountryCode, max(EffectiveDate) as last from dd group by 1) using (CountryCode)"""
RESTORED = ", ".join(
    f"round(h.{q} * (case when std = 0 then 1 else std end) + mean, 3) as {q}_Day{d}" for q in Q for d in range(2, 11)
)


@query(
    "scaled_forecast",
    sql("dd params_dd", f"""select {GK}, g.EffectiveDate, {RESTORED}
        from g asof left join st h on {ON} and g.EffectiveDate >= h.EffectiveDate
        join params_dd p on p.CountryCode = g.CountryCode and p.Currency = g.Currency and p.BranchId = g.BranchId""",
        st=SCALED_STATES, g=LAST_ORIGIN),
)
def _(spark, sf):
    return rounded(scaled_forecast(staged(demand_daily(spark, sf), "history"), TrailingQuantile(SPEC)), 3)


LOGGED_STATES = f"""select {K}, EffectiveDate, quantile_cont(z, 0.1) over w as p10,
    quantile_cont(z, 0.5) over w as p50, quantile_cont(z, 0.9) over w as p90
    from (select {K}, EffectiveDate, ln(1 + case when Demand - 6000000 <= 0 then coalesce(0.01 * min(case when Demand > 6000000
              then Demand - 6000000 end) over (partition by CountryCode), 0.01) else Demand - 6000000 end) as z from dd)
    window w as (partition by {K} order by EffectiveDate rows between 27 preceding and current row)"""


@query(
    "logged_forecast",
    sql("dd", f"""select {GK}, null::varchar as CountryName, g.EffectiveDate,
        cast(g.EffectiveDate + cast(j as integer) as date) as ForecastDate,
        {', '.join(f'round(greatest(0.0::double, exp(h.{q}) - 1), 3) as {q}' for q in Q)},
        cast(j + 1 as integer) as horizon_day
        from g asof left join st h on {ON} and g.EffectiveDate >= h.EffectiveDate
        cross join range(1, 11) r(j)""", st=LOGGED_STATES, g=LAST_ORIGIN),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history").withColumn(DEMAND, F.col(DEMAND) - 6000000)
    return rounded(logged_forecast(dd, TrailingQuantile(SPEC), latest_origin(dd)), 3)
