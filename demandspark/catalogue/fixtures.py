"""Demand tables derived from the given tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.forecasters import WeekdayQuantile, backtest
from demandspark.operators.reshape import evaluation_table
from demandspark.spec import (
    BRANCH, COUNTRY, CURRENCY, DATE, DEMAND, PRODUCT, SERIES_KEYS, ForecastSpec,
)
from demandspark.staging import staged

SPEC = ForecastSpec()
KEYS = list(SERIES_KEYS)
K = ", ".join(SERIES_KEYS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _minor_units(amount):
    """Whole hundredths: their sum is exact, so it does not depend on the order of rows."""
    return F.sum(F.round(amount * 100))


def demand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few long, gappy series: line items by part class, supplier region and status."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(
            (F.col("l_partkey") % 3).cast("string").alias(PRODUCT),
            F.col("n_regionkey").cast("string").alias(BRANCH),
            F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias(COUNTRY),
            F.when(F.col("l_linestatus") == "F", "USD").otherwise("ZMW").alias(CURRENCY),
            F.col("l_shipdate").cast("date").alias(DATE),
        )
        .agg(_minor_units(revenue).alias(DEMAND))
    )


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few short, almost dense series: events by type and user class."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias(PRODUCT),
            (F.col("user_id") % 10).cast("string").alias(BRANCH),
            F.lit("ZM").alias(COUNTRY),
            F.lit("USD").alias(CURRENCY),
            F.col("ts").cast("date").alias(DATE),
        )
        .agg(_minor_units(F.col("value")).alias(DEMAND))
    )


def customer_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sparse series, one per customer: their number grows with the data."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.col("c_mktsegment").alias(PRODUCT),
            F.col("o_custkey").cast("string").alias(BRANCH),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias(COUNTRY),
            F.lit("USD").alias(CURRENCY),
            F.col("o_orderdate").cast("date").alias(DATE),
        )
        .agg(_minor_units(F.col("o_totalprice")).alias(DEMAND))
    )


def weekday_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday-quantile forecasts of the event series from every origin."""
    return backtest(staged(events_daily(spark, sf_dir), "history"), WeekdayQuantile(SPEC))


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same forecasts by target date, beside actual demand."""
    history = staged(events_daily(spark, sf_dir), "history")
    return evaluation_table(backtest(history, WeekdayQuantile(SPEC)), history, SPEC)


# SQL bodies of the same tables, and of forecasts on them.
CTES = {
    "dd": """
        select cast(l_partkey % 3 as varchar) as ProductId, cast(n_regionkey as varchar) as BranchId,
               concat('C', cast(n_regionkey as varchar)) as CountryCode,
               case when l_linestatus = 'F' then 'USD' else 'ZMW' end as Currency,
               cast(l_shipdate as date) as EffectiveDate,
               sum(round(l_extendedprice * (1 - l_discount) * 100)) as Demand
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        group by 1, 2, 3, 4, 5""",
    "ed": """
        select event_type as ProductId, cast(user_id % 10 as varchar) as BranchId,
               'ZM' as CountryCode, 'USD' as Currency, cast(ts as date) as EffectiveDate,
               sum(round(value * 100)) as Demand
        from events group by 1, 2, 3, 4, 5""",
    "cd": """
        select c_mktsegment as ProductId, cast(o_custkey as varchar) as BranchId,
               concat('N', cast(c_nationkey as varchar)) as CountryCode, 'USD' as Currency,
               cast(o_orderdate as date) as EffectiveDate, sum(round(o_totalprice * 100)) as Demand
        from orders join customer on o_custkey = c_custkey
        group by 1, 2, 3, 4, 5""",
    "ed_grid": f"""
        select {K}, EffectiveDate, cast(EffectiveDate + cast(j as integer) as date) as ForecastDate
        from (select distinct {K} from ed)
        join (select distinct CountryCode, EffectiveDate from ed) using (CountryCode)
        cross join range(1, 11) r(j)""",
    "wq": f"""
        select {', '.join('g.' + k for k in KEYS)}, g.EffectiveDate, g.ForecastDate,
               quantile_cont(h.Demand, 0.1) as p10, quantile_cont(h.Demand, 0.5) as p50,
               quantile_cont(h.Demand, 0.9) as p90
        from ed_grid g left join ed h
          on {' and '.join(f'g.{k} = h.{k}' for k in KEYS)}
         and dayname(h.EffectiveDate) = dayname(g.ForecastDate)
         and h.EffectiveDate <= g.EffectiveDate and h.EffectiveDate > g.EffectiveDate - 56
        group by {', '.join('g.' + k for k in KEYS)}, g.EffectiveDate, g.ForecastDate""",
    "fl": """
        select *, cast(ForecastDate - EffectiveDate + 1 as integer) as ForecastDay
        from wq where ForecastDate - EffectiveDate + 1 between 1 and 10""",
    "ev": f"""
        select {', '.join('w.' + k for k in KEYS)}, w.ForecastDate as EffectiveDate, h.Demand,
               p10, p50, p90, cast(w.ForecastDate - w.EffectiveDate as integer) as ForecastStep
        from wq w left join ed h
          on {' and '.join(f'w.{k} = h.{k}' for k in KEYS)} and w.ForecastDate = h.EffectiveDate""",
    "params": """
        select CountryCode, Currency, BranchId, avg(Demand) as mean, stddev_samp(Demand) as std,
               min(Demand) as min, max(Demand) as max,
               arg_max(Demand, {d: EffectiveDate, p: ProductId}) as last_value,
               count(*) as n_observations
        from SOURCE group by all""",
}


def sql(names: str, body: str, recursive: bool = False, **more: str) -> str:
    """``with`` the named tables, then ``body``; ``params_dd`` are the parameters of ``dd``."""
    parts = []
    for name in names.split():
        if name.startswith("params_"):
            parts.append(f"{name} as ({CTES['params'].replace('SOURCE', name[7:])})")
        else:
            parts.append(f"{name} as ({CTES[name]})")
    parts += [f"{name} as ({text})" for name, text in more.items()]
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(parts) + "\n" + body
