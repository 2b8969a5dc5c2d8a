"""Request grids and as-of states."""

from __future__ import annotations

from demandspark.catalogue.fixtures import K, KEYS, SPEC, demand_daily, events_daily, sql
from demandspark.catalogue.registry import query, rounded
from demandspark.forecasters import TrailingQuantile
from demandspark.operators.grid import (
    all_origins, carry_forward, latest_origin, origin_grid, request_grid, step_grid,
)
from demandspark.operators.prepare import series_template
from demandspark.spec import DATE, DEMAND, TARGET_DATE, WEEKDAY
from demandspark.staging import staged

GRID = f"""select {K}, EffectiveDate, ForecastDate, cast(null as double) as Demand,
    dayname(ForecastDate) as DayOfWeekName from ed_grid"""


@query("request_grid_all", sql("ed ed_grid", GRID))
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    return request_grid(series_template(ed), all_origins(ed), SPEC).select(
        *KEYS, DATE, TARGET_DATE, DEMAND, WEEKDAY
    )


@query(
    "request_grid_latest",
    sql("ed ed_grid", GRID + " where EffectiveDate = (select max(EffectiveDate) from ed)"),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    return request_grid(series_template(ed), latest_origin(ed), SPEC).select(
        *KEYS, DATE, TARGET_DATE, DEMAND, WEEKDAY
    )


@query(
    "step_grid",
    sql("dd", f"""select distinct {K}, cast(last + 1 as date) as EffectiveDate, cast(null as double) as Demand
        from dd join (select CountryCode, max(EffectiveDate) as last from dd group by 1) using (CountryCode)"""),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    return step_grid(series_template(dd), latest_origin(dd)).select(*KEYS, DATE, DEMAND)


DD_ORIGINS = f"""select {K}, EffectiveDate from (select distinct {K} from dd)
    join (select distinct CountryCode, EffectiveDate from dd) using (CountryCode)"""


@query(
    "asof_state",
    sql("dd", f"""select {', '.join('g.' + k for k in KEYS)}, g.EffectiveDate, round(h.Demand, 4) as State
        from g asof left join dd h on {' and '.join(f'g.{k} = h.{k}' for k in KEYS)}
        and g.EffectiveDate >= h.EffectiveDate""", g=DD_ORIGINS),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    grid = origin_grid(series_template(dd), all_origins(dd))
    states = dd.withColumnRenamed(DEMAND, "State")
    return rounded(carry_forward(grid, states, KEYS, ["State"]), 4)


TRAILING = f"""select {K}, EffectiveDate, round(quantile_cont(Demand, 0.1) over w, 4) as p10,
    round(quantile_cont(Demand, 0.5) over w, 4) as p50, round(quantile_cont(Demand, 0.9) over w, 4) as p90
    from dd window w as (partition by {K} order by EffectiveDate rows between 27 preceding and current row)"""


@query("trailing_quantile", sql("dd", TRAILING))
def _(spark, sf):
    return rounded(TrailingQuantile(SPEC).fit(demand_daily(spark, sf)), 4)


@query(
    "trailing_backtest",
    sql("dd", f"""select {', '.join('g.' + k for k in KEYS)}, g.EffectiveDate, p10, p50, p90
        from g asof left join t h on {' and '.join(f'g.{k} = h.{k}' for k in KEYS)}
        and g.EffectiveDate >= h.EffectiveDate""", g=DD_ORIGINS, t=TRAILING),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    model = TrailingQuantile(SPEC)
    grid = origin_grid(series_template(dd), all_origins(dd))
    return rounded(model.predict(model.fit(dd), grid), 4)
