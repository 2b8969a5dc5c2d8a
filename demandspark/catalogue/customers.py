"""The same operators on many sparse series, whose number grows with the data."""

from __future__ import annotations

from demandspark.catalogue.fixtures import K, KEYS, SPEC, customer_daily, sql
from demandspark.catalogue.forecasting import recursion
from demandspark.catalogue.registry import query, rounded
from demandspark.forecasters import TrailingQuantile, WeekdayQuantile, backtest, iterative_forecast
from demandspark.operators.diagnose import autocorrelation, iqr_outliers, seasonal_patterns
from demandspark.operators.grid import latest_origin
from demandspark.operators.scaling import apply_scaling, scaling_params
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec
from demandspark.staging import staged

ON = " and ".join(f"g.{k} = h.{k}" for k in KEYS)
GK = ", ".join("g." + k for k in KEYS)
Q = SPEC.quantiles.names
ROUND_Q = ", ".join(f"round({q}, 4) as {q}" for q in Q)


@query(
    "customer_scaling_params",
    sql("cd params_cd", """select CountryCode, Currency, BranchId, round(mean, 4) as mean, round(std, 2) as std,
        round(min, 4) as min, round(max, 4) as max, round(last_value, 4) as last_value, n_observations from params_cd"""),
)
def _(spark, sf):
    return rounded(rounded(scaling_params(staged(customer_daily(spark, sf), "history")), 2, "std"), 4)


@query(
    "customer_scaled",
    sql("cd params_cd", f"""select {K}, EffectiveDate, round((Demand - mean) /
        (case when std = 0 then 1 else std end), 6) as Demand
        from cd join params_cd using (CountryCode, Currency, BranchId)"""),
)
def _(spark, sf):
    cd = staged(customer_daily(spark, sf), "history")
    return rounded(apply_scaling(cd, scaling_params(cd)), 6).select(*KEYS, DATE, DEMAND)


GRID = f"""select {K}, last as EffectiveDate, cast(last + cast(j as integer) as date) as ForecastDate
    from (select distinct {K} from cd)
    join (select CountryCode, max(EffectiveDate) as last from cd group by 1) using (CountryCode)
    cross join range(1, 11) r(j)"""


@query(
    "customer_trailing_forecast",
    sql("cd", f"""select {GK}, g.EffectiveDate, g.ForecastDate, {', '.join(f'round(h.{q}, 4) as {q}' for q in Q)}
        from g asof left join st h on {ON} and g.EffectiveDate >= h.EffectiveDate""", g=GRID,
        st=f"""select {K}, EffectiveDate, {', '.join(f'quantile_cont(Demand, {p}) over w as {q}' for q, p in SPEC.quantiles.levels)}
        from cd window w as (partition by {K} order by EffectiveDate rows between 27 preceding and current row)"""),
)
def _(spark, sf):
    cd = staged(customer_daily(spark, sf), "history")
    scored = backtest(cd, TrailingQuantile(SPEC), latest_origin(cd))
    return rounded(scored, 4).select(*KEYS, DATE, TARGET_DATE, *Q)


@query(
    "customer_weekday_forecast",
    sql("cd", f"""select {GK}, g.EffectiveDate, g.ForecastDate,
        {', '.join(f'round(quantile_cont(h.Demand, {p}), 4) as {q}' for q, p in SPEC.quantiles.levels)}
        from g left join cd h on {ON} and dayname(h.EffectiveDate) = dayname(g.ForecastDate)
        and h.EffectiveDate <= g.EffectiveDate and h.EffectiveDate > g.EffectiveDate - 56
        group by {GK}, g.EffectiveDate, g.ForecastDate""", g=GRID),
)
def _(spark, sf):
    cd = staged(customer_daily(spark, sf), "history")
    scored = backtest(cd, WeekdayQuantile(SPEC), latest_origin(cd))
    return rounded(scored, 4).select(*KEYS, DATE, TARGET_DATE, *Q)


@query(
    "customer_iterative_forecast",
    sql("cd", f"select {K}, EffectiveDate, ForecastStep, {ROUND_Q} from iter", recursive=True, **recursion("cd", 20)),
)
def _(spark, sf):
    return rounded(iterative_forecast(customer_daily(spark, sf), ForecastSpec(iterative_steps=20)), 4)


@query(
    "customer_outliers",
    sql("cd", f"""select {K}, EffectiveDate, round(Demand, 4) as Demand, round(q1, 4) as q1, round(q3, 4) as q3,
        round(q1 - 1.5 * (q3 - q1), 4) as lower, round(q3 + 1.5 * (q3 - q1), 4) as upper
        from cd join (select {K}, quantile_cont(Demand, 0.25) as q1, quantile_cont(Demand, 0.75) as q3
                      from cd group by {K}) using ({K})
        where Demand < q1 - 1.5 * (q3 - q1) or Demand > q3 + 1.5 * (q3 - q1)"""),
)
def _(spark, sf):
    return rounded(iqr_outliers(customer_daily(spark, sf), SPEC), 4)


LAGGED = f"""select {K}, lag, Demand, case lag {' '.join(f'when {k} then lag(Demand, {k}) over w' for k in range(1, 8))} end as y
    from (select *, cast(j as integer) as lag from cd cross join range(1, 8) r(j))
    window w as (partition by {K}, lag order by EffectiveDate)"""


@query(
    "customer_autocorrelation",
    sql("cd", f"""select {K}, n_rows, lag, round(acf, 6) as acf, round(1.96 / sqrt(n_rows), 6) as bound,
        coalesce(abs(acf) > 0.7, false) as strong from (
        select {K}, lag, count(*) as n_rows,
               case when isnan(corr(Demand, y)) then null else corr(Demand, y) end as acf
        from l group by {K}, lag)""", l=LAGGED),
)
def _(spark, sf):
    return rounded(autocorrelation(customer_daily(spark, sf), 7, SPEC), 6)


@query(
    "customer_seasons",
    sql("cd", f"""select {K}, kind, period, n_rows, round(p.mean, 2) as mean, round(p.std, 2) as std,
        round(p.mean / s.mean, 6) as ratio from (
        select {K}, 'weekday' as kind, dayname(EffectiveDate) as period, count(*) as n_rows,
               avg(Demand) as mean, stddev_samp(Demand) as std from cd group by {K}, dayname(EffectiveDate)
        union all
        select {K}, 'month', strftime(EffectiveDate, '%m'), count(*), avg(Demand), stddev_samp(Demand)
        from cd group by {K}, strftime(EffectiveDate, '%m')) p
        join (select {K}, avg(Demand) as mean from cd group by {K}) s using ({K})"""),
)
def _(spark, sf):
    patterns = rounded(seasonal_patterns(customer_daily(spark, sf), SPEC), 6, "ratio")
    return rounded(patterns, 2, "mean", "std")
