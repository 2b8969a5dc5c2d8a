"""Projection, typing, repair, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import (
    K, KEYS, SPEC, demand_daily, evaluation, events_daily, sql, table,
)
from demandspark.catalogue.registry import query, rounded
from demandspark.functions.columns import (
    strip_quotes, strip_thousands, to_day, to_number, unlog_demand,
)
from demandspark.operators.grid import all_origins, origin_batches
from demandspark.operators.holidays import RULES_SCHEMA, holiday_calendar
from demandspark.operators.prepare import (
    add_calendar, add_missing_columns, date_range, demand_signs, flag_holidays, keep_one,
    log_transform, prefix_keys, prepare_demand, project, repair_nonpositive, series_template,
    train_future_split,
)
from demandspark.operators.profile import first_rows
from demandspark.operators.reshape import order_quantiles, union_all
from demandspark.operators.validate import null_counts
from demandspark.spec import COUNTRY, DATE, DEMAND
from demandspark.staging import staged


@query("series_template", sql("dd", f"select distinct {K} from dd"))
def _(spark, sf):
    return series_template(demand_daily(spark, sf))


NULLABLE = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("null_profile", "select " + ", ".join(f"count(*) - count({c}) as {c}" for c in NULLABLE) + " from orders")
def _(spark, sf):
    return null_counts(table(spark, sf, "orders"), NULLABLE)


@query(
    "prepare_demand",
    sql("dd", f"select {K}, EffectiveDate, Demand from dd"),
)
def _(spark, sf):
    raw = staged(demand_daily(spark, sf), "history").withColumn(DATE, F.date_format(DATE, "yyyy-MM-dd HH:mm:ss"))
    return prepare_demand(raw)


@query(
    "key_prefix",
    sql("dd", "select 'P' || ProductId as ProductId, 'B' || BranchId as BranchId, CountryCode, Currency, "
              "EffectiveDate, Demand from dd"),
)
def _(spark, sf):
    return prefix_keys(demand_daily(spark, sf), {"ProductId": "P", "BranchId": "B"})


@query(
    "calendar_columns",
    sql("ed", f"""select {K}, EffectiveDate, Demand, dayname(EffectiveDate) as DayOfWeekName,
        case when CountryCode = 'ZM' then 'Zambia' end as CountryName from ed"""),
)
def _(spark, sf):
    return add_calendar(events_daily(spark, sf))


@query(
    "parse_dates",
    """select l_orderkey, l_linenumber, cast(l_shipdate as date) as EffectiveDate from lineitem""",
)
def _(spark, sf):
    # Text with an offset: the wall-clock day counts, not the shifted one.
    text = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+09:30"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", to_day(text).alias(DATE)
    )


@query(
    "parse_date_formats",
    """select l_orderkey, l_linenumber, case when l_linenumber % 4 <> 3 then cast(l_shipdate as date) end as EffectiveDate
        from lineitem""",
)
def _(spark, sf):
    day = F.col("l_shipdate")
    # Two formats tried in order, then ISO; the last is none of them.
    text = F.when(F.col("l_linenumber") % 4 == 0, F.date_format(day, "dd/MM/yyyy")).when(
        F.col("l_linenumber") % 4 == 1, F.date_format(day, "yyyyMMdd")
    ).when(F.col("l_linenumber") % 4 == 2, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "MMM d, yyyy"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", to_day(text, ("dd/MM/yyyy", "yyyyMMdd")).alias(DATE)
    )


def _as_text(df):
    """Demand as an export would hold it: padded, quoted, with commas; failures on Fridays."""
    shown = F.concat(F.lit('  "'), F.format_number(DEMAND, 2), F.lit('" '))
    return df.withColumn(
        "DemandText", F.when(F.date_format(DATE, "EEEE") == "Friday", "ERROR").otherwise(shown)
    )


@query(
    "coerce_numeric",
    sql("dd", f"""select {K}, EffectiveDate,
        case when dayname(EffectiveDate) <> 'Friday' then Demand end as Cleaned from dd"""),
)
def _(spark, sf):
    cleaned = strip_thousands(strip_quotes(F.col("DemandText")))
    return _as_text(demand_daily(spark, sf)).select(*KEYS, DATE, cleaned.alias("Cleaned"))


@query(
    "coerce_plain",
    sql("ed", f"select {K}, EffectiveDate, case when dayname(EffectiveDate) <> 'Friday' then Demand end as Demand from ed"),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    text = F.when(F.date_format(DATE, "EEEE") == "Friday", "n/a").otherwise(F.col(DEMAND).cast("string"))
    return ed.withColumn(DEMAND, to_number(text))


SHIFTED = {"low": f"select {K}, EffectiveDate, Demand - 6000000 as Demand from dd"}


@query(
    "repair_nonpositive",
    sql("dd", f"""select {K}, EffectiveDate, round(case when Demand <= 0 then coalesce(
        0.01 * min(case when Demand > 0 then Demand end) over (partition by CountryCode), 0.01)
        else Demand end, 4) as Demand from low""", **SHIFTED),
)
def _(spark, sf):
    low = staged(demand_daily(spark, sf), "history").withColumn(DEMAND, F.col(DEMAND) - 6000000)
    return rounded(repair_nonpositive(low), 4)


@query(
    "demand_signs",
    sql("dd", """select CountryCode, count(*) filter (where Demand = 0) as n_zero,
        count(*) filter (where Demand < 0) as n_negative,
        round(min(Demand) filter (where Demand > 0), 4) as min_positive from low group by 1""", **SHIFTED),
)
def _(spark, sf):
    low = demand_daily(spark, sf).withColumn(DEMAND, F.col(DEMAND) - 6000000)
    return rounded(demand_signs(low), 4)


@query("log_transform", sql("ed", f"select {K}, EffectiveDate, round(ln(1 + Demand), 6) as Demand from ed"))
def _(spark, sf):
    return rounded(log_transform(events_daily(spark, sf)), 6)


NULLED = f"""select {K}, EffectiveDate,
    case when day(EffectiveDate) = 9 then null else ln(1 + Demand) - 4 end as x from ed"""


def _logged(spark, sf):
    x = F.when(F.day(DATE) != 9, F.log1p(DEMAND) - 4)
    return events_daily(spark, sf).select(*KEYS, DATE, x.alias("x"))


@query(
    "log_inverse",
    sql("ed", f"""select {K}, EffectiveDate, round(case when x is not null then
        greatest(0.0::double, exp(x) - 1) end, 4) as x from n""", n=NULLED),
)
def _(spark, sf):
    return rounded(_logged(spark, sf).withColumn("x", unlog_demand(F.col("x"))), 4)


SMALL = f"""select {K}, EffectiveDate,
    case when day(EffectiveDate) = 9 then null else ln(1 + ln(1 + Demand)) - 1 end as x from ed"""


@query(
    "log_inverse_twice",
    sql("ed", f"""select {K}, EffectiveDate, round(case when x is not null then
        greatest(0.0::double, exp(greatest(0.0::double, exp(x) - 1)) - 1) end, 4) as x from n""", n=SMALL),
)
def _(spark, sf):
    x = F.when(F.day(DATE) != 9, F.log1p(F.log1p(DEMAND)) - 1)
    twice = events_daily(spark, sf).select(*KEYS, DATE, unlog_demand(x, passes=2).alias("x"))
    return rounded(twice, 4)


@query(
    "quantile_order",
    sql("ed ed_grid wq ev", f"""select {K}, EffectiveDate, ForecastStep,
        round(least(p90, p50), 4) as p10, round(p50, 4) as p50, round(greatest(p50, p10), 4) as p90 from ev"""),
)
def _(spark, sf):
    crossed = evaluation(spark, sf).select(
        *KEYS, DATE, "ForecastStep", F.col("p90").alias("p10"), "p50", F.col("p10").alias("p90")
    )
    return rounded(order_quantiles(crossed, SPEC), 4)


STEPS = 10


@query(
    "train_future_split",
    sql("ed", f"""select {K}, EffectiveDate, Demand,
        max(EffectiveDate) over (partition by CountryCode) - {STEPS} as Cutoff,
        case when EffectiveDate <= max(EffectiveDate) over (partition by CountryCode) - {STEPS}
             then 'train' else 'future' end as part from ed"""),
)
def _(spark, sf):
    return train_future_split(staged(events_daily(spark, sf), "history"), STEPS).select(*KEYS, DATE, DEMAND, "Cutoff", "part")


@query(
    "date_range",
    sql("dd", "select CountryCode, min(EffectiveDate) as first_date, max(EffectiveDate) as last_date from dd group by 1"),
)
def _(spark, sf):
    return date_range(demand_daily(spark, sf))


TWICE = f"""select {K}, EffectiveDate, Demand, 0 as source from ed
    union all select {K}, EffectiveDate, Demand * 2, 1 from ed"""


def _twice(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    return union_all(
        [ed.withColumn("source", F.lit(0)), ed.withColumns({DEMAND: F.col(DEMAND) * 2, "source": F.lit(1)})]
    )


def _deduped(direction: str) -> str:
    return sql("ed", f"""select {K}, EffectiveDate, round(Demand, 4) as Demand, source from twice
        qualify row_number() over (partition by {K}, EffectiveDate order by source {direction}) = 1""", twice=TWICE)


@query("dedupe_first", _deduped("asc"))
def _(spark, sf):
    return rounded(keep_one(_twice(spark, sf), F.col("source"), "first"), 4).select(*KEYS, DATE, DEMAND, "source")


@query("dedupe_last", _deduped("desc"))
def _(spark, sf):
    return rounded(keep_one(_twice(spark, sf), F.col("source"), "last"), 4).select(*KEYS, DATE, DEMAND, "source")


@query(
    "projection",
    sql("dd", "select EffectiveDate, ProductId, BranchId, Currency, Demand as Target, cast(null as varchar) as CountryName from dd"),
)
def _(spark, sf):
    df = project(demand_daily(spark, sf), [DATE, *KEYS, DEMAND])
    return add_missing_columns(df, {"CountryName": "string", "Currency": "string"}).drop(COUNTRY).withColumnRenamed(
        DEMAND, "Target"
    )


BATCH = 7
BATCHES = f"""select CountryCode, EffectiveDate,
    cast(ceil(row_number() over (partition by CountryCode order by EffectiveDate) / {BATCH}.0) as integer) as batch
    from (select distinct CountryCode, EffectiveDate from ed)"""


@query("origin_batches", sql("ed", "select * from b", b=BATCHES))
def _(spark, sf):
    return origin_batches(all_origins(events_daily(spark, sf)), BATCH)


@query(
    "union_batches",
    sql("ed", f"select {K}, EffectiveDate, Demand, batch from ed join b using (CountryCode, EffectiveDate)", b=BATCHES),
)
def _(spark, sf):
    ed = staged(events_daily(spark, sf), "history")
    tagged = ed.join(origin_batches(all_origins(ed), BATCH), [COUNTRY, DATE]).select(*KEYS, DATE, DEMAND, "batch")
    first, later = tagged.where("batch = 1"), tagged.where("batch > 1")
    return union_all([first, later])


HOLIDAYS = [("ZM", "2024-01-01", "New Year"), ("ZM", "2024-01-15", "Fixture Day")]


@query(
    "holiday_flag",
    sql("ed", f"""select {K}, EffectiveDate, Demand,
        EffectiveDate in (date '2024-01-01', date '2024-01-15') as IsHoliday from ed"""),
)
def _(spark, sf):
    days = spark.createDataFrame(HOLIDAYS, "CountryCode string, date string, holiday string")
    return flag_holidays(events_daily(spark, sf), days.withColumn("date", F.col("date").cast("date")))


# The rules of the query's calendar, the same for every country of the data.
RULES = [
    ("New Year", "fixed", 1, 1, None, None, "nearest"),
    ("Leap day", "fixed", 2, 29, None, None, "none"),
    ("Good Friday", "easter", None, -2, None, None, "none"),
    ("Easter Monday", "easter", None, 1, None, None, "none"),
    ("Heroes", "weekday", 7, None, 1, 1, "none"),
    ("Last Thursday", "weekday", 11, None, 4, -1, "none"),
    ("Christmas", "fixed", 12, 25, None, None, "monday"),
]
RULE_FIELDS = [f.split() for f in RULES_SCHEMA.split(", ")[1:]]
# Full moons of the 19 golden numbers as days after 21 March, valid from 1900 to 2199.
MOONS = "[24, 13, 2, 21, 10, 28, 18, 7, 26, 15, 4, 23, 12, 1, 20, 9, 27, 17, 6]"


@query(
    "holiday_calendar",
    sql("dd", """select c.CountryCode, h.holiday, h.date, h.actual, count(dd.Demand) as n_rows, round(sum(dd.Demand), 2) as demand
        from (select distinct CountryCode from dd) c cross join h
        left join dd on dd.CountryCode = c.CountryCode and dd.EffectiveDate = h.date
        group by all""",
        span="select unnest(range(min(year(EffectiveDate)), max(year(EffectiveDate)) + 1)) as y from dd",
        days="select cast(d as date) as d from (select unnest(generate_series(make_date(min(y), 1, 1), make_date(max(y), 12, 31), interval 1 day)) as d from span)",
        easter=f"""select y, (select min(d) from days where isodow(d) = 7
            and d > make_date(y, 3, 21) + cast({MOONS}[(y % 19) + 1] as integer)) as e from span""",
        h="""select 'New Year' as holiday, make_date(y, 1, 1) as actual, make_date(y, 1, 1)
                + case isodow(make_date(y, 1, 1)) when 6 then -1 when 7 then 1 else 0 end as date from span
            union all select 'Leap day', d, d from days where month(d) = 2 and day(d) = 29
            union all select 'Good Friday', e - 2, e - 2 from easter
            union all select 'Easter Monday', e + 1, e + 1 from easter
            union all select 'Heroes', min(d), min(d) from days where month(d) = 7 and isodow(d) = 1 group by year(d)
            union all select 'Last Thursday', max(d), max(d) from days where month(d) = 11 and isodow(d) = 4 group by year(d)
            union all select 'Christmas', make_date(y, 12, 25), make_date(y, 12, 25)
                + case isodow(make_date(y, 12, 25)) when 6 then 2 when 7 then 1 else 0 end from span"""),
)
def _(spark, sf):
    """Demand of each country on the days its rules make holidays, over the years of the data."""
    dd = staged(demand_daily(spark, sf), "history")
    years = dd.agg(F.min(F.year(DATE)), F.max(F.year(DATE))).first()
    per_country = F.explode(F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, RULE_FIELDS)]) for r in RULES]))
    rules = dd.select(COUNTRY).distinct().select(COUNTRY, per_country.alias("r")).select(COUNTRY, "r.*")
    calendar = holiday_calendar(rules, *years)
    on_day = dd.select(COUNTRY, F.col(DATE).alias("date"), DEMAND)
    return calendar.join(on_day, [COUNTRY, "date"], "left").groupBy(COUNTRY, "holiday", "date", "actual").agg(
        F.count(DEMAND).alias("n_rows"), F.round(F.sum(DEMAND), 2).alias("demand")
    )


@query(
    "first_rows",
    sql("dd", f"select {K}, EffectiveDate, Demand from dd order by {K}, EffectiveDate limit 5"),
)
def _(spark, sf):
    return first_rows(demand_daily(spark, sf), [*KEYS, DATE], 5)


@query(
    "sorted_dates",
    sql("dd", "select distinct CountryCode, EffectiveDate from dd order by 1, 2"),
)
def _(spark, sf):
    return all_origins(demand_daily(spark, sf)).orderBy(COUNTRY, DATE)
