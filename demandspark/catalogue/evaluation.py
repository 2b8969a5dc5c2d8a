"""Accuracy, describe tables, flags and the statistics report."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import K, KEYS, SPEC, evaluation, events_daily, sql, weekday_backtest
from demandspark.catalogue.registry import query, rounded
from demandspark.forecasters import WeekdayQuantile
from demandspark.operators.evaluate import (
    accuracy_by_series, accuracy_summary, describe_forecasts, forecast_flags, group_flags, with_status,
)
from demandspark.operators.reshape import forecast_long
from demandspark.operators.scaling import scaling_params
from demandspark.plans.scaled import forecast_report
from demandspark.sources.params import global_stats
from demandspark.spec import DATE, DEMAND
from demandspark.staging import staged

LONG = "ed ed_grid wq fl"
G = "CountryCode, Currency, BranchId"
MELTED = " union all ".join(
    f"select {G}, '{q}' as quantile, {q} as value from fl" for q in SPEC.quantiles.names
)
DESCRIBE = """count(value) as count, round(avg(value), 4) as mean, round(stddev_samp(value), 4) as std,
    round(min(value), 4) as min, round(quantile_cont(value, 0.25), 4) as "25%",
    round(quantile_cont(value, 0.5), 4) as "50%", round(quantile_cont(value, 0.75), 4) as "75%",
    round(max(value), 4) as max"""


def _long(spark, sf):
    return forecast_long(weekday_backtest(spark, sf), SPEC)


@query("forecast_describe", sql(LONG, f"select {G}, quantile, {DESCRIBE} from m group by {G}, quantile", m=MELTED))
def _(spark, sf):
    return rounded(describe_forecasts(staged(_long(spark, sf), "forecasts"), SPEC), 4)


# Training parameters of a tenth of the size, so that some forecasts are extreme.
SHRUNK = """select CountryCode, Currency, BranchId, mean / 10 as mean, std / 10 as std, min / 10 as min,
    max / 10 as max, last_value / 10 as last_value, n_observations from params_ed"""
FLAGS = f"""select {G}, quantile, count(*) as n_rows,
    count(*) filter (where abs((value - mean) / (case when std = 0 then 1 else std end)) > 5) as outliers,
    count(*) filter (where value < 0) as negative_values
    from (select {G}, quantile, value - 5000 as value from m) join small using ({G}) group by {G}, quantile"""


def _shrunk(spark, sf):
    params = scaling_params(staged(events_daily(spark, sf), "history"))
    return staged(params.withColumns({c: F.col(c) / 10 for c in ("mean", "std", "min", "max", "last_value")}), "params")


def _lowered(spark, sf):
    return _long(spark, sf).withColumns({q: F.col(q) - 5000 for q in SPEC.quantiles.names})


@query("zscore_outliers", sql(f"{LONG} params_ed", "select * from f", m=MELTED, small=SHRUNK, f=FLAGS))
def _(spark, sf):
    return forecast_flags(_lowered(spark, sf), _shrunk(spark, sf), SPEC)


@query(
    "negative_flags",
    sql(f"{LONG} params_ed", f"""select {G}, bool_or(negative_values > 0) as negative_values,
        bool_or(outliers > 0) as extreme_outliers from f group by {G}""", m=MELTED, small=SHRUNK, f=FLAGS),
)
def _(spark, sf):
    return group_flags(forecast_flags(_lowered(spark, sf), _shrunk(spark, sf), SPEC), SPEC)


@query(
    "global_stats",
    sql(LONG, """select count(*) as total_forecasts, '20240131-000000' as timestamp, 'StandardScaler' as scaling_method,
        10 as forecast_horizon, 'p10,p50,p90' as quantiles from fl"""),
)
def _(spark, sf):
    return global_stats(_long(spark, sf), "20240131-000000", "StandardScaler", SPEC)


@query(
    "stats_report",
    sql(f"{LONG} params_ed", f"""select {G}, quantile, {DESCRIBE.replace('value', 'x')},
        count(*) filter (where abs((x - a) / (case when s = 0 then 1 else s end)) > 5) as outliers,
        count(*) filter (where x < 0) as negative_values
        from (select {G}, quantile, value as x from m)
        join (select {G}, mean as a, std as s from params_ed) using ({G}) group by {G}, quantile""", m=MELTED),
)
def _(spark, sf):
    """The nested report as JSON documents, parsed back and flattened."""
    forecasts = staged(_long(spark, sf), "forecasts")
    params = scaling_params(staged(events_daily(spark, sf), "history"))
    report = forecast_report(forecasts, params, WeekdayQuantile(SPEC))
    documents = report.select(F.to_json(F.struct(*report.columns)).alias("value"))
    parsed = documents.select(F.from_json("value", report.schema).alias("r")).select("r.*")
    flat = parsed.select(
        *SPEC.scaling_keys, F.explode("quantile_stats").alias("quantile", "s")
    ).select(*SPEC.scaling_keys, "quantile", "s.basic_stats.*", "s.outliers", "s.negative_values")
    return rounded(flat, 4)


ZEROED = "select * replace (case when day(EffectiveDate) = 7 then 0 else Demand end as Demand) from ev"


def _zeroed(spark, sf):
    """Evaluation rows with zero demand on one day of the month."""
    d = F.when(F.day(DATE) == 7, 0.0).otherwise(F.col(DEMAND))
    return evaluation(spark, sf).withColumn(DEMAND, d)


ACCURACY = f"""select {K}, avg(abs(Demand - p50) / nullif(Demand, 0)) * 100 as mape,
    avg(abs(Demand - p50) / nullif(abs(Demand), 0)) * 100 as mape_abs,
    avg(case when Demand >= p10 and Demand <= p90 then 1.0::double else 0.0::double end) * 100 as coverage,
    sqrt(avg(power(Demand - p50, 2))) as rmse, count(*) as n_rows, count(Demand - p50) as n_scored,
    count(*) filter (where Demand = 0) as n_zero_demand from z group by {K}"""
EVALUATED = "ed ed_grid wq ev"
ROUNDED_ACCURACY = f"""{K}, round(mape, 4) as mape, round(mape_abs, 4) as mape_abs, round(coverage, 4) as coverage,
    round(rmse, 4) as rmse, n_rows, n_scored, n_zero_demand"""


@query("accuracy_by_series", sql(EVALUATED, f"select {ROUNDED_ACCURACY} from a", z=ZEROED, a=ACCURACY))
def _(spark, sf):
    return rounded(accuracy_by_series(_zeroed(spark, sf), SPEC), 4)


@query(
    "accuracy_status",
    sql(EVALUATED, f"""select {K}, round(mape, 4) as mape, round(coverage, 4) as coverage,
        case when mape is null then 'error' else 'success' end as status,
        case when mape is null then 'no row with demand and forecast' end as error from a""",
        z=ZEROED.replace("day(EffectiveDate) = 7", "BranchId = '7'"), a=ACCURACY),
)
def _(spark, sf):
    d = F.when(F.col("BranchId") == "7", 0.0).otherwise(F.col(DEMAND))
    accuracy = accuracy_by_series(evaluation(spark, sf).withColumn(DEMAND, d), SPEC)
    return rounded(with_status(accuracy).select(*KEYS, "mape", "coverage", "status", "error"), 4)


@query(
    "accuracy_summary",
    sql(EVALUATED, f"""select metric, n_series, n_success, n_error, {DESCRIBE} from (
        select 'mape' as metric, mape as value from a union all select 'coverage', coverage from a)
        cross join (select count(*) as n_series, count(mape) as n_success, count(*) - count(mape) as n_error from a)
        group by metric, n_series, n_success, n_error""", z=ZEROED, a=ACCURACY),
)
def _(spark, sf):
    return rounded(accuracy_summary(accuracy_by_series(_zeroed(spark, sf), SPEC)), 4)
