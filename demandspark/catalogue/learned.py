"""Fitted quantiles, reconciled forecasts and states carried to new days."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import K, KEYS, SPEC, demand_daily, events_daily, sql
from demandspark.catalogue.registry import query, rounded
from demandspark.forecasters import TrailingQuantile, backtest
from demandspark.forecasters.conformal import widened_bands
from demandspark.forecasters.state import advance, forecast_states, state_of
from demandspark.functions.quantile_fit import fit_quantiles, pinball
from demandspark.plans.reconciled import reconciled_forecast
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec
from demandspark.staging import staged

LEVELS = SPEC.quantiles.probabilities
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


# With one feature for each weekday the best fit is known: an order statistic of the weekday.
@query(
    "quantile_regression",
    sql("ed", f"""select p as level, round(avg(greatest((Demand - q) * p, (Demand - q) * (p - 1))), 0) as loss,
            round(count(*) filter (where Demand < q) / count(*), 2) as share_below
        from (select *, first_value(Demand) over (partition by p, wd order by abs(r - greatest(1, ceil(p * n - 1e-9)))) as q from ranked)
        group by p""", ranked=f"""select *, row_number() over (partition by p, wd order by Demand) as r,
            count(*) over (partition by p, wd) as n
            from (select dayname(EffectiveDate) as wd, Demand from ed), (select unnest({LEVELS})::double as p)"""),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    features = [f"is_{d}" for d in WEEKDAYS]
    day = F.date_format(DATE, "EEEE")
    rows = staged(ed.select(F.col(DEMAND).alias("label"), *[(day == d).cast("double").alias(f"is_{d}") for d in WEEKDAYS]), "rows")
    fits = fit_quantiles(rows, features, "label", LEVELS)

    def of(level: float):
        fit = sum((F.col(f) * w for f, w in zip(features, fits[None, level])), F.lit(0.0))
        miss = F.col("label") - fit
        return F.struct(
            F.lit(level).alias("level"), F.avg(pinball(miss, level)).alias("loss"),
            F.avg((miss < 0).cast("double")).alias("share_below"),
        )

    found = rows.agg(F.array(*[of(p) for p in LEVELS]).alias("f")).select(F.explode("f").alias("f")).select("f.*")
    return rounded(rounded(found, 0, "loss"), 2, "share_below")


def _level(number: int, keys: str) -> dict[str, str]:
    """Base forecast of a level: quantiles of the last rows of each of its series."""
    return {
        f"b{number}": f"""select {keys}, quantile_cont(Demand, 0.5) as f, greatest(
                power((quantile_cont(Demand, 0.9) - quantile_cont(Demand, 0.1)) / (2 * 1.2815515655446004::double), 2), 1e-12) as v
            from (select *, row_number() over (partition by {keys} order by EffectiveDate desc) as back from (
                select {keys}, EffectiveDate, sum(Demand) as Demand from dd group by {keys}, EffectiveDate))
            where back <= 28 group by {keys}""",
    }


def _sweep(number: int, keys: str) -> dict[str, str]:
    return {
        f"s{number}": f"select {keys}, sum(m) as sm, sum(v) as sv from u{number - 1} group by {keys}",
        f"u{number}": f"""select {keys}, f, (f / v + sm / sv) / (1 / v + 1 / sv) as m, 1 / (1 / v + 1 / sv) as v, sm, sv
            from b{number} join s{number} using ({keys})""",
    }


L1, L2 = "BranchId, CountryCode, Currency", "CountryCode, Currency"
RECONCILED = " union all ".join(
    f"""select {i} as level, {p} as ProductId, {b} as BranchId, r.CountryCode, r.Currency, o.EffectiveDate,
        cast(o.EffectiveDate + cast(j as integer) as date) as ForecastDate, round(f, 2) as value, round(r, 2) as p50
        from r{i} r join o using (CountryCode) cross join range(1, 11) t(j)"""
    for i, p, b in ((0, "r.ProductId", "r.BranchId"), (1, "cast(null as varchar)", "r.BranchId"), (2, "cast(null as varchar)", "cast(null as varchar)"))
)


@query(
    "reconciled_forecast",
    sql("dd", RECONCILED, **_level(0, "ProductId, " + L1), **_level(1, L1), **_level(2, L2),
        u0=f"select ProductId, {L1}, f, f as m, v from b0", **_sweep(1, L1), **_sweep(2, L2),
        r2="select *, m as r from u2",
        r1=f"select u1.*, u1.m + u1.v / u2.sv * (r2.r - u2.sm) as r from u1 join u2 using ({L2}) join r2 using ({L2})",
        r0=f"select u0.*, u0.m + u0.v / u1.sv * (r1.r - u1.sm) as r from u0 join u1 using ({L1}) join r1 using ({L1})",
        o="select CountryCode, max(EffectiveDate) as EffectiveDate from dd group by 1"),
)
def _(spark, sf):
    found = reconciled_forecast(demand_daily(spark, sf), TrailingQuantile, SPEC)
    return rounded(found.select("level", *KEYS, DATE, TARGET_DATE, "value", "p50"), 2)


# The days on which the stored states are brought up to date.
STATE_DAYS = ("2024-01-10", "2024-01-20")


@query(
    "state_forecast",
    sql("ed", f"""select 'trailing_quantile' as method, {K}, max(EffectiveDate) as EffectiveDate,
            round(quantile_cont(Demand, 0.1) filter (where back <= 28), 4) as p10,
            round(quantile_cont(Demand, 0.5) filter (where back <= 28), 4) as p50,
            round(quantile_cont(Demand, 0.9) filter (where back <= 28), 4) as p90 from aged group by {K}
        union all select 'exp_smoothing', {K}, last, round(lvl - z * spr, 4), round(lvl, 4), round(lvl + z * spr, 4)
        from (select {K}, last, any_value(mu) + sum(w * d) / sum(w) as lvl, 1.2815515655446004::double as z,
                sqrt(greatest(0.0::double, sum(w * d * d) / sum(w) - power(sum(w * d) / sum(w), 2))) as spr
            from (select *, Demand - mu as d, power(0.7::double, last - EffectiveDate) as w from aged) group by {K}, last)""",
        aged=f"""select *, row_number() over (partition by {K} order by EffectiveDate desc) as back,
            max(EffectiveDate) over (partition by {K}) as last, avg(Demand) over (partition by {K}) as mu from ed"""),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    first, second = STATE_DAYS
    day = F.col(DATE)
    state = staged(state_of(ed.where(day < first), SPEC), "states")
    state = staged(advance(state, ed.where((day >= first) & (day < second)), SPEC), "states")
    return rounded(forecast_states(advance(state, ed.where(day >= second), SPEC), SPEC), 4)


CHAIN = f"{K}, EffectiveDate, ForecastDate"
# One list of states a chain, a row at a time; a row uses the state known at its origin.
TRACKED = f"""select {K}, cast(0 as bigint) as k, [0.0::double] as states, 0.0::double as total, 0.0::double as used
    from (select distinct {K} from scored)
    union all
    select {', '.join('c.' + k for k in KEYS)}, c.k + 1, list_append(c.states, c.states[c.k + 1]
            + case when r.s is null then 0.0::double else 0.25::double * (c.total + r.e) / r.seen
                * (case when r.s > c.states[r.known + 1] then 1.0::double else 0.0::double end - (1.0::double - 0.8::double)) end),
        c.total + coalesce(r.e, 0), c.states[r.known + 1]
    from chain c join ranked r on {' and '.join(f'c.{k} = r.{k}' for k in KEYS)} and r.k = c.k + 1"""
NEXT_DAY = ForecastSpec(horizon=1)


@query(
    "widened_bands",
    sql("ed", f"""select {CHAIN}, round(case when p10 is not null then least(p10 - used, p50) end, 3) as p10, round(p50, 3) as p50,
            round(case when p90 is not null then greatest(p90 + used, p50) end, 3) as p90, round(used, 3) as widen
        from ranked join chain using ({K}, k)""",
        recursive=True,
        states=f"""select {K}, EffectiveDate, quantile_cont(Demand, 0.1) over w as p10,
            quantile_cont(Demand, 0.5) over w as p50, quantile_cont(Demand, 0.9) over w as p90
            from ed window w as (partition by {K} order by EffectiveDate rows between 27 preceding and current row)""",
        grid=f"""select {K}, EffectiveDate, cast(EffectiveDate + 1 as date) as ForecastDate from (select distinct {K} from ed)
            join (select distinct CountryCode, EffectiveDate from ed) using (CountryCode)""",
        made=f"""select {', '.join('g.' + k for k in KEYS)}, g.EffectiveDate, g.ForecastDate, round(p10, 4) as p10, p50, round(p90, 4) as p90 from grid g
            asof left join states h on {' and '.join(f'g.{k} = h.{k}' for k in KEYS)} and g.EffectiveDate >= h.EffectiveDate""",
        scored=f"""select m.*, case when p10 is not null then greatest(p10 - Demand, Demand - p90) end as s,
            case when p10 is not null then abs(Demand - p50) end as e
            from made m left join (select {K}, EffectiveDate as ForecastDate, Demand from ed) a using ({K}, ForecastDate)""",
        ranked=f"""select *, row_number() over w as k, count(s) over w as seen,
                count(*) over (partition by {K} order by ForecastDate range between unbounded preceding and interval 1 day preceding) as known
            from scored window w as (partition by {K} order by ForecastDate)""",
        chain=TRACKED),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    scored = rounded(backtest(ed, TrailingQuantile(NEXT_DAY)), 4)
    return rounded(widened_bands(scored, ed, 0.8, NEXT_DAY).select(*KEYS, DATE, TARGET_DATE, *SPEC.quantiles.names, "widen"), 3)
