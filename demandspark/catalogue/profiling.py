"""Column profiles of the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import table
from demandspark.catalogue.registry import query, rounded
from demandspark.functions.normal_scores import quantile_sql
from demandspark.operators.evaluate import describe_by
from demandspark.operators.profile import (
    box_stats, column_profile, correlation_matrix, histogram, jarque_bera, melt, numeric_columns, prediction_sentinels,
    shapiro_francia,
)

# Column types of the line item table.
TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
NUMERIC = [c for c, t in TYPES.items() if t not in ("string", "timestamp_ntz")]
MELTED = " union all ".join(f"select '{c}' as \"column\", cast({c} as double) as v from lineitem" for c in NUMERIC)


def _lineitem(spark, sf):
    return table(spark, sf, "lineitem")


@query(
    "column_profile",
    " union all ".join(
        f"select '{c}' as \"column\", '{t}' as type, count({c}) as n_present, count(*) - count({c}) as n_null, "
        f"count(distinct {c}) as n_distinct, count(*) as n_rows from lineitem"
        for c, t in TYPES.items()
    ),
)
def _(spark, sf):
    return column_profile(_lineitem(spark, sf))


@query(
    "correlation_matrix",
    " union all ".join(
        f"select '{a}' as x, '{b}' as y, round(corr({a}, {b}), 6) as corr from lineitem" for a in NUMERIC for b in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(correlation_matrix(_lineitem(spark, sf), NUMERIC), 6)


@query(
    "histogram20",
    f"""with m as ({MELTED}), r as (select "column", min(v) as lo, max(v) as hi from m group by 1)
    select "column", cast(least(floor((v - lo) / (hi - lo) * 20), 19) as integer) as bin,
        round(any_value(lo) + bin * any_value(hi - lo) / 20, 4) as "left",
        round(any_value(lo) + (bin + 1) * any_value(hi - lo) / 20, 4) as "right", count(*) as n
    from m join r using ("column") group by 1, 2""",
)
def _(spark, sf):
    return rounded(histogram(_lineitem(spark, sf), NUMERIC), 4)


@query(
    "box_stats",
    f"""with m as ({MELTED}), q as (select "column", quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median,
        quantile_cont(v, 0.75) as q3 from m group by 1)
    select "column", round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3,
        round(min(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 4) as whisker_low,
        round(max(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 4) as whisker_high,
        count(*) filter (where v not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as n_fliers, count(*) as n
    from m join q using ("column") group by "column", q1, median, q3""",
)
def _(spark, sf):
    return rounded(box_stats(_lineitem(spark, sf), NUMERIC), 4)


@query(
    "jarque_bera",
    f"""with m as ({MELTED}), c as (select "column", avg(v) as mu from m group by 1),
    k as (select "column", count(*) as n, avg(power(v - mu, 2)) as m2, avg(power(v - mu, 3)) as m3,
        avg(power(v - mu, 4)) as m4 from m join c using ("column") group by 1),
    s as (select "column", n, m3 / power(m2, 1.5) as sk, m4 / (m2 * m2) - 3 as ku from k)
    select "column", n, round(sk, 6) as skewness, round(ku, 6) as excess_kurtosis,
        round(n / 6.0 * (sk * sk + ku * ku / 4), 3) as jarque_bera,
        round(exp(-(n / 6.0 * (sk * sk + ku * ku / 4)) / 2), 6) as p_value from s""",
)
def _(spark, sf):
    screened = jarque_bera(_lineitem(spark, sf), NUMERIC)
    return rounded(rounded(screened, 3, "jarque_bera"), 6, "skewness", "excess_kurtosis", "p_value")


@query(
    "shapiro_francia",
    f"""with m as ({MELTED}), r as (select *, row_number() over (partition by "column" order by v) as i,
        count(*) over (partition by "column") as n, avg(v) over (partition by "column") as mu from m),
    p as (select *, (i - 0.375) / (n + 0.25)::double as p from r),
    s as (select "column", n, v - mu as d, {quantile_sql('p')} as q from p),
    w as (select "column", n, power(sum(d * q), 2) / (sum(q * q) * sum(d * d)) as w from s group by 1, 2)
    select "column", n, round(w, 6) as w, round((ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n))))
        / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))), 4) as z from w""",
)
def _(spark, sf):
    return rounded(rounded(shapiro_francia(_lineitem(spark, sf), NUMERIC), 6, "w"), 4, "z")


@query(
    "describe_table",
    f"""with m as ({MELTED}) select "column", count(v) as count, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as std,
        round(min(v), 4) as min, round(quantile_cont(v, 0.25), 4) as "25%", round(quantile_cont(v, 0.5), 4) as "50%",
        round(quantile_cont(v, 0.75), 4) as "75%", round(max(v), 4) as max from m group by 1""",
)
def _(spark, sf):
    lineitem = _lineitem(spark, sf)
    return rounded(describe_by(melt(lineitem, numeric_columns(lineitem)), ["column"], "value"), 4)


@query(
    "prediction_sentinels",
    """select c as "column", count(v) as n_present, count(*) filter (where v = 'ERROR') as n_sentinel from (
        select 'p10' as c, case when l_linestatus = 'F' then 'ERROR' else cast(l_quantity as varchar) end as v from lineitem
        union all select 'p50', case when l_returnflag = 'N' then 'ERROR' end from lineitem) group by 1""",
)
def _(spark, sf):
    cells = _lineitem(spark, sf).select(
        F.when(F.col("l_linestatus") == "F", "ERROR").otherwise(F.col("l_quantity").cast("string")).alias("p10"),
        F.when(F.col("l_returnflag") == "N", "ERROR").alias("p50"),
    )
    return prediction_sentinels(cells)
