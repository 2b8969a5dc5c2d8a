"""Outliers, autocorrelation, consistency and patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import (
    K, KEYS, SPEC, demand_daily, evaluation, events_daily, sql,
)
from demandspark.catalogue.registry import query, rounded
from demandspark.operators.diagnose import (
    autocorrelation, branch_patterns, consistency_steps, forecast_consistency, hampel_outliers, iqr_outliers,
    outlier_report, outliers_by_weekday, seasonal_patterns, valid_combinations,
)
from demandspark.operators.prepare import series_template
from demandspark.plans.diagnosis import full_diagnosis, section_counts
from demandspark.spec import DATE, FORECAST_STEP
from demandspark.staging import staged

BOUNDS = f"""select {K}, q1, q3, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from (
    select {K}, quantile_cont(Demand, 0.25) as q1, quantile_cont(Demand, 0.75) as q3 from dd group by {K})"""
OUTLIERS = f"""select {K}, EffectiveDate, Demand, q1, q3, lower, upper
    from dd join b using ({K}) where Demand < lower or Demand > upper"""


@query(
    "iqr_outliers",
    sql("dd", f"""select {K}, EffectiveDate, round(Demand, 4) as Demand, round(q1, 4) as q1, round(q3, 4) as q3,
        round(lower, 4) as lower, round(upper, 4) as upper from o""", b=BOUNDS, o=OUTLIERS),
)
def _(spark, sf):
    return rounded(iqr_outliers(demand_daily(spark, sf), SPEC), 4)


@query(
    "outlier_report",
    sql("dd", f"""select {K}, count(*) as n_outliers, any_value(n_rows) as n_rows,
        string_agg(distinct cast(EffectiveDate as varchar), ',' order by cast(EffectiveDate as varchar)) as dates,
        round(min(Demand), 4) as min_outlier, round(max(Demand), 4) as max_outlier,
        round(count(*) / any_value(n_rows) * 100.0::double, 4) as pct_outliers
        from o join (select {K}, count(*) as n_rows from dd group by {K}) using ({K}) group by {K}""", b=BOUNDS, o=OUTLIERS),
)
def _(spark, sf):
    report = outlier_report(demand_daily(spark, sf), SPEC)
    days = F.array_join(F.transform("dates", lambda d: d.cast("string")), ",")
    return rounded(report.withColumn("dates", days), 4)


@query(
    "outliers_by_weekday",
    sql("dd", f"""select {K}, dayname(EffectiveDate) as DayOfWeekName, count(*) as n_outliers
        from o group by {K}, dayname(EffectiveDate)""", b=BOUNDS, o=OUTLIERS),
)
def _(spark, sf):
    return outliers_by_weekday(demand_daily(spark, sf), SPEC)


@query(
    "hampel_outliers",
    sql("dd", f"""select {K}, EffectiveDate, round(Demand, 4) as Demand, round(m, 4) as moving_median, round(mad, 4) as moving_mad,
        round(m - 3 * 1.4826::double * mad, 4) as lower, round(m + 3 * 1.4826::double * mad, 4) as upper
        from (select *, list_aggregate(list_transform(near, lambda x: abs(x - m)), 'median') as mad from (
            select *, median(Demand) over w as m, list(Demand) over w as near from dd
            window w as (partition by {K} order by EffectiveDate rows between 7 preceding and 7 following)))
        where Demand < m - 3 * 1.4826::double * mad or Demand > m + 3 * 1.4826::double * mad"""),
)
def _(spark, sf):
    return rounded(hampel_outliers(demand_daily(spark, sf), spec=SPEC), 4)


CONSISTENCY = f"""select {K}, EffectiveDate, count(*) as n_forecasts, round(stddev_samp(p50), 4) as p50_std,
    round(max(p50) - min(p50), 4) as p50_range,
    count(distinct p50) + max(case when p50 is null then 1 else 0 end) as n_values
    from ev group by {K}, EffectiveDate having count(*) > 1
    and count(distinct p50) + max(case when p50 is null then 1 else 0 end) > 1"""


@query("forecast_consistency", sql("ed ed_grid wq ev", f"select * replace (cast(n_values as bigint) as n_values) from c", c=CONSISTENCY))
def _(spark, sf):
    return rounded(forecast_consistency(evaluation(spark, sf), SPEC), 4)


@query(
    "consistency_steps",
    sql("ed ed_grid wq ev", f"""select {K}, EffectiveDate, ForecastStep, round(p50, 4) as p50
        from ev join (select {K}, EffectiveDate from c) using ({K}, EffectiveDate)""", c=CONSISTENCY),
)
def _(spark, sf):
    return rounded(consistency_steps(evaluation(spark, sf), SPEC), 4).select(*KEYS, DATE, FORECAST_STEP, "p50")


def _acf(source: str, lagged: str) -> str:
    return f"""select {K}, n_rows, lag, round(acf, 6) as acf, round(1.96 / sqrt(n_rows), 6) as bound,
        coalesce(abs(acf) > 0.7, false) as strong from (
        select {K}, any_value(n_rows) as n_rows, lag, case when isnan(corr(Demand, y)) then null else corr(Demand, y) end as acf
        from {lagged} join (select {K}, count(*) as n_rows from {source} group by {K}) using ({K}) group by {K}, lag)"""


ROW_LAGS = " union all ".join(
    f"select {K}, {k} as lag, Demand, lag(Demand, {k}) over (partition by {K} order by EffectiveDate) as y from ed"
    for k in range(1, 8)
)
DAY_LAGS = f"""select {', '.join('a.' + k for k in KEYS)}, cast(j as integer) as lag, a.Demand, b.Demand as y
    from dd a cross join range(1, 8) r(j) left join dd b
    on {' and '.join(f'a.{k} = b.{k}' for k in KEYS)} and b.EffectiveDate = a.EffectiveDate - cast(j as integer)"""


@query("autocorrelation", sql("ed", _acf("ed", "l"), l=ROW_LAGS))
def _(spark, sf):
    return rounded(autocorrelation(events_daily(spark, sf), 7, SPEC), 6)


@query("autocorrelation_calendar", sql("dd", _acf("dd", "l"), l=DAY_LAGS))
def _(spark, sf):
    return rounded(autocorrelation(demand_daily(spark, sf), 7, SPEC, calendar=True), 6)


@query(
    "branch_patterns",
    sql("dd", f"""select {K}, n_rows, round(mean, 2) as mean, round(std, 2) as std, round(total, 2) as total,
        round(total / sum(total) over (partition by CountryCode, BranchId), 6) as share from (
        select {K}, count(*) as n_rows, avg(Demand) as mean, stddev_samp(Demand) as std, sum(Demand) as total
        from dd group by {K})"""),
)
def _(spark, sf):
    patterns = rounded(branch_patterns(demand_daily(spark, sf), SPEC), 6, "share")
    return rounded(patterns, 2, "mean", "std", "total")


@query(
    "seasonal_patterns",
    sql("dd", f"""select {K}, kind, period, n_rows, round(p.mean, 2) as mean, round(p.std, 2) as std,
        round(p.mean / s.mean, 6) as ratio from (
        select {K}, 'weekday' as kind, dayname(EffectiveDate) as period, count(*) as n_rows,
               avg(Demand) as mean, stddev_samp(Demand) as std from dd group by {K}, dayname(EffectiveDate)
        union all
        select {K}, 'month', strftime(EffectiveDate, '%m'), count(*), avg(Demand), stddev_samp(Demand)
        from dd group by {K}, strftime(EffectiveDate, '%m')) p
        join (select {K}, avg(Demand) as mean from dd group by {K}) s using ({K})"""),
)
def _(spark, sf):
    patterns = rounded(seasonal_patterns(demand_daily(spark, sf), SPEC), 6, "ratio")
    return rounded(patterns, 2, "mean", "std")


@query(
    "valid_combinations",
    sql("dd", f"""select distinct w.ProductId, w.BranchId, w.Currency, h.Currency is not null as exists
        from (select distinct ProductId, BranchId, Currency from dd union
              select distinct ProductId, BranchId, 'EUR' from dd) w
        left join (select distinct ProductId, BranchId, Currency from dd) h
        on w.ProductId = h.ProductId and w.BranchId = h.BranchId and w.Currency = h.Currency"""),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    known = series_template(dd, ["ProductId", "BranchId", "Currency"])
    wanted = known.union(known.withColumn("Currency", F.lit("EUR")).distinct())
    return valid_combinations(wanted, dd, SPEC)


@query(
    "full_diagnosis",
    sql("ed ed_grid wq ev", f"""select 'branch_patterns' as section, count(*) as n_rows from (select distinct {K} from ed)
        union all select 'seasonal_patterns', (select count(*) from (select distinct {K}, dayname(EffectiveDate) from ed))
            + (select count(*) from (select distinct {K}, month(EffectiveDate) from ed))
        union all select 'outliers', count(*) from o
        union all select 'outlier_report', count(*) from (select distinct {K} from o)
        union all select 'outliers_by_weekday', count(*) from (select distinct {K}, dayname(EffectiveDate) from o)
        union all select 'autocorrelation', 7 * count(*) from (select distinct {K} from ed)
        union all select 'forecast_consistency', count(*) from c
        union all select 'history', count(*) from ed
        union all select 'forecast', count(*) from ev""",
        b=BOUNDS.replace("dd", "ed"), o=OUTLIERS.replace("dd", "ed"), c=CONSISTENCY),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    forecasts = staged(evaluation(spark, sf), "evaluation")
    return section_counts(full_diagnosis(ed, forecasts, series_template(ed), SPEC))
