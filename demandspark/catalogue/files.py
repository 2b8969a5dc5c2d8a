"""Round trips through written files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import K, KEYS, SPEC, demand_daily, events_daily, sql, weekday_backtest
from demandspark.catalogue.registry import query, rounded
from demandspark.operators.prepare import series_template
from demandspark.operators.profile import numeric_text, prediction_sentinels
from demandspark.operators.scaling import scaling_params
from demandspark.sources.params import read_params_json, write_params_json
from demandspark.sources.predictions import (
    align_by_position, read_keyed_predictions, read_predictions, read_predictions_tail, with_file_rows,
)
from demandspark.sources.tables import read_demand, read_template, write_run, write_table
from demandspark.spec import DATE, DEMAND, TARGET_DATE
from demandspark.staging import staged, staging_path

Q = SPEC.quantiles.names
ROUND_Q = ", ".join(f"round({q}, 4) as {q}" for q in Q)


@query("demand_roundtrip", sql("dd", f"select {K}, EffectiveDate, round(Demand, 4) as Demand, '20240131-000000' as run_ts from dd"))
def _(spark, sf):
    path = staging_path(spark, "demand")
    write_run(demand_daily(spark, sf), path, "20240131-000000", fmt="csv")
    back = read_demand(spark, path)
    return rounded(back, 4).select(*KEYS, DATE, DEMAND, F.col("run_ts").cast("string").alias("run_ts"))


@query("demand_many_files", sql("dd", f"select {K}, EffectiveDate, round(Demand, 4) as Demand from dd"))
def _(spark, sf):
    """Files of different headers: other column orders, further columns, and one without the country."""
    rows = staged(demand_daily(spark, sf), "rows")
    shapes = [
        (F.col("Currency") == "USD", [*KEYS, DATE, DEMAND]),
        ((F.col("Currency") != "USD") & (F.col("CountryCode") != "C0"), [DEMAND, "Note", DATE, *reversed(KEYS)]),
        ((F.col("Currency") != "USD") & (F.col("CountryCode") == "C0"), [DATE, *[k for k in KEYS if k != "CountryCode"], DEMAND]),
    ]
    paths = []
    for which, columns in shapes:
        paths.append(staging_path(spark, "demand"))
        write_table(rows.where(which).withColumn("Note", F.lit('a, "b"')).select(*columns), paths[-1])
    back = read_demand(spark, paths[:2]).select(*KEYS, DATE, DEMAND).unionByName(
        read_demand(spark, paths[2], country="C0").select(*KEYS, DATE, DEMAND)
    )
    return rounded(back, 4)


POLICY_STEPS = (("raise", 1.0), ("skip", 2.0), ("overwrite", 3.0), ("skip", 4.0))


@query(
    "write_policies",
    sql("dd", f"""select step, policy, {K}, EffectiveDate, round(Demand * f, 2) as Demand from dd,
        (values (0, 'raise', 1.0::double), (1, 'skip', 1.0::double), (2, 'overwrite', 3.0::double), (3, 'skip', 3.0::double)) t(step, policy, f)"""),
)
def _(spark, sf):
    """What a table holds after each of a row of writes to it; skip leaves what is there."""
    rows = staged(demand_daily(spark, sf), "rows")
    path, seen = staging_path(spark, "written"), []
    for step, (policy, factor) in enumerate(POLICY_STEPS):
        write_table(rows.withColumn(DEMAND, F.col(DEMAND) * factor), path, policy, "parquet")
        held = spark.read.parquet(path).select(F.lit(step).alias("step"), F.lit(policy).alias("policy"), *KEYS, DATE, DEMAND)
        seen.append(staged(held, "held"))
    return rounded(reduce(DataFrame.unionByName, seen), 2)


@query("template_read", sql("dd", f"select distinct {K} from dd"))
def _(spark, sf):
    path = staging_path(spark, "template")
    write_table(series_template(demand_daily(spark, sf)), path)
    return read_template(spark, path)


@query(
    "params_json_files",
    sql("dd params_dd", """select CountryCode, Currency, BranchId, round(mean, 4) as mean, round(std, 4) as std,
        round(min, 4) as min, round(max, 4) as max, round(last_value, 4) as last_value, n_observations from params_dd"""),
)
def _(spark, sf):
    path = staging_path(spark, "params-json")
    write_params_json(scaling_params(staged(demand_daily(spark, sf), "history")), path)
    return rounded(read_params_json(spark, path), 4)


def _write_headerless(df, path):
    df.write.option("header", False).option("quote", "").option("escapeQuotes", False).csv(path)


@query(
    "raw_predictions",
    sql("ed", """select case when dayname(EffectiveDate) <> 'Friday' then round(Demand * 0.8, 2) end as p10,
        round(Demand, 2) as p50, round(Demand * 1.2, 2) as p90 from ed"""),
)
def _(spark, sf):
    cells = events_daily(spark, sf).select(
        F.when(F.date_format(DATE, "EEEE") == "Friday", "ERROR").otherwise((F.col(DEMAND) * 0.8).cast("string")),
        F.col(DEMAND).cast("string"),
        (F.col(DEMAND) * 1.2).cast("string"),
    )
    path = staging_path(spark, "predictions")
    _write_headerless(cells, path)
    return rounded(read_predictions(spark, path), 2)


@query(
    "raw_predictions_last_n",
    sql("ed", "select round(Demand * 0.8, 2) as p10, round(Demand, 2) as p50, round(Demand * 1.2, 2) as p90 from ed"),
)
def _(spark, sf):
    def quoted(c):
        return F.concat(F.lit(' "'), c.cast("string"), F.lit('" '))

    d = F.col(DEMAND)
    cells = events_daily(spark, sf).select(
        F.col("ProductId"), F.col("BranchId"), quoted(d * 0.8), quoted(d), quoted(d * 1.2)
    )
    path = staging_path(spark, "predictions")
    _write_headerless(cells, path)
    return rounded(read_predictions_tail(spark, path), 2)


@query(
    "keyed_predictions",
    sql("ed ed_grid wq", f"select {K}, EffectiveDate, ForecastDate, {ROUND_Q} from wq"),
)
def _(spark, sf):
    path = staging_path(spark, "keyed")
    write_table(weekday_backtest(spark, sf), path)
    back = read_keyed_predictions(spark, path, [*KEYS, DATE, TARGET_DATE])
    return rounded(back, 4).select(
        *KEYS, F.col(DATE).cast("date").alias(DATE), F.col(TARGET_DATE).cast("date").alias(TARGET_DATE), *Q
    )


@query(
    "positional_align",
    sql("dd", f"""select {K}, EffectiveDate, round(Demand * 0.5, 2) as p10, round(Demand, 2) as p50,
        round(Demand * 2, 2) as p90 from dd"""),
)
def _(spark, sf):
    """Requests and keyless predictions written as separate files with the same rows in order."""
    rows = staged(demand_daily(spark, sf).repartition(4, *KEYS).sortWithinPartitions(*KEYS, DATE), "rows")
    tagged = rows.withColumn("part", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1))
    requests, predictions = staging_path(spark, "requests"), staging_path(spark, "predictions")
    # One file per part, rows in one order on both sides.
    ordered = tagged.repartition(8, "part").sortWithinPartitions("part", *KEYS, DATE)
    d = F.col(DEMAND)
    ordered.select("part", *KEYS, DATE).write.partitionBy("part").option("header", False).csv(requests)
    ordered.select("part", d * 0.5, d, d * 2).write.partitionBy("part").option("header", False).csv(predictions)
    names = ", ".join(f"{k} string" for k in [*KEYS, DATE])
    left = with_file_rows(spark.read.schema(names + ", part string").csv(requests))
    right = with_file_rows(
        spark.read.schema("p10 double, p50 double, p90 double, part string").csv(predictions)
    )
    # File names differ between two writes; the part they belong to does not.
    joined = align_by_position(
        left.withColumn("file", F.col("part")).drop("part"), right.withColumn("file", F.col("part")).drop("part")
    )
    return rounded(joined, 2).select(*KEYS, F.col(DATE).cast("date").alias(DATE), *Q)


@query(
    "sentinel_files",
    sql("ed", """select c as "column", count(v) as n_present, count(*) filter (where v = 'ERROR') as n_sentinel from (
        select 'p10' as c, case when dayname(EffectiveDate) = 'Friday' then 'ERROR' else 'x' end as v from ed
        union all select 'p50', 'x' from ed) group by 1"""),
)
def _(spark, sf):
    cells = events_daily(spark, sf).select(
        F.when(F.date_format(DATE, "EEEE") == "Friday", "ERROR").otherwise(F.col(DEMAND).cast("string")).alias("p10"),
        F.col(DEMAND).cast("string").alias("p50"),
    )
    path = staging_path(spark, "predictions")
    write_table(cells, path)
    return prediction_sentinels(spark.read.option("header", True).csv(path))


@query(
    "numeric_text",
    "select o_orderkey, round(o_totalprice, 2) as CashOutOrdersAmount from orders where o_orderpriority <> '1-URGENT'",
)
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = F.when(F.col("o_orderpriority") != "1-URGENT", F.format_number("o_totalprice", 2))
    amounts = orders.select("o_orderkey", text.alias("CashOutOrdersAmount"))
    return rounded(numeric_text(amounts, "CashOutOrdersAmount"), 2)
