"""Scaling parameters and their use."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalogue.fixtures import K, KEYS, SPEC, demand_daily, evaluation, events_daily, sql
from demandspark.catalogue.registry import query, rounded
from demandspark.operators.prepare import series_template
from demandspark.operators.scaling import (
    apply_scaling, inverse_scaling, missing_groups, scaling_params, scaling_violations, unused_groups,
)
from demandspark.sources.params import (
    metadata_rows, params_from_json, params_to_json, scaling_metadata,
)
from demandspark.spec import DATE, DEMAND
from demandspark.staging import staged

FIELDS = """CountryCode, Currency, BranchId, round(mean, 4) as mean, round(std, 4) as std,
    round(min, 4) as min, round(max, 4) as max, round(last_value, 4) as last_value, n_observations"""


@query("scaling_params", sql("dd params_dd", f"select {FIELDS} from params_dd"))
def _(spark, sf):
    return rounded(scaling_params(staged(demand_daily(spark, sf), "history")), 4)


@query(
    "apply_scaling",
    sql("dd params_dd", f"""select {K}, EffectiveDate, round((Demand - mean) /
        (case when std = 0 then 1 else std end), 6) as Demand
        from dd join params_dd using (CountryCode, Currency, BranchId)"""),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    return rounded(apply_scaling(dd, scaling_params(dd)), 6).select(*KEYS, DATE, DEMAND)


@query(
    "apply_scaling_unmatched",
    sql("dd params_dd", f"""select {K}, EffectiveDate, round(case when Currency = 'USD' then (Demand - mean) /
        (case when std = 0 then 1 else std end) else Demand end, 4) as Demand
        from dd join params_dd using (CountryCode, Currency, BranchId)"""),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    usd_only = scaling_params(dd.where("Currency = 'USD'"))
    return rounded(apply_scaling(dd, usd_only), 4).select(*KEYS, DATE, DEMAND)


@query(
    "inverse_scaling",
    sql("ed ed_grid wq ev params_ed", f"""select {K}, EffectiveDate, ForecastStep,
        {', '.join(f'round({q} / 1e5::double * (case when std = 0 then 1 else std end) + mean, 2) as {q}' for q in ('p10', 'p50', 'p90'))}
        from ev join params_ed using (CountryCode, Currency, BranchId)"""),
)
def _(spark, sf):
    params = scaling_params(staged(events_daily(spark, sf), "history"))
    # Brought down to the size of scaled forecasts first.
    scaled = evaluation(spark, sf).withColumns({q: F.col(q) / 1e5 for q in SPEC.quantiles.names})
    restored = inverse_scaling(scaled, params, SPEC.quantiles.names)
    return rounded(restored, 2).select(*KEYS, DATE, "ForecastStep", *SPEC.quantiles.names)


BAD = """select CountryCode, case when BranchId = '4' then null else Currency end as Currency, BranchId,
    case when Currency = 'ZMW' and BranchId = '3' then null else mean end as mean,
    case when BranchId = '0' then -std else std end as std, min,
    case when BranchId = '1' then min - 1 else max end as max, last_value,
    case when BranchId = '2' then 0 else n_observations end as n_observations from params_dd"""


@query(
    "scaling_violations",
    sql("dd params_dd", """select CountryCode, Currency, BranchId, 'null_key' as rule from bad where Currency is null
        union all select CountryCode, Currency, BranchId, 'missing_field' from bad where mean is null
        union all select CountryCode, Currency, BranchId, 'negative_std' from bad where std < 0
        union all select CountryCode, Currency, BranchId, 'max_below_min' from bad where max < min
        union all select CountryCode, Currency, BranchId, 'no_observations' from bad where n_observations <= 0""", bad=BAD),
)
def _(spark, sf):
    params = scaling_params(staged(demand_daily(spark, sf), "history"))
    branch = F.col("BranchId")
    lost_mean = (F.col("Currency") == "ZMW") & (branch == "3")
    bad = params.select(
        "CountryCode", F.when(branch != "4", F.col("Currency")).alias("Currency"), "BranchId",
        F.when(~lost_mean, F.col("mean")).alias("mean"),
        F.when(branch == "0", -F.col("std")).otherwise(F.col("std")).alias("std"),
        "min",
        F.when(branch == "1", F.col("min") - 1).otherwise(F.col("max")).alias("max"),
        "last_value",
        F.when(branch == "2", 0).otherwise(F.col("n_observations")).alias("n_observations"),
    )
    return scaling_violations(bad)


@query(
    "missing_groups",
    sql("dd", """select distinct CountryCode, Currency, BranchId from dd t where not exists (
        select 1 from dd h where h.EffectiveDate < date '1997-06-01' and h.CountryCode = t.CountryCode
        and h.Currency = t.Currency and h.BranchId = t.BranchId and h.Currency = 'USD')"""),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    old = scaling_params(dd.where("EffectiveDate < date'1997-06-01' and Currency = 'USD'"))
    return missing_groups(series_template(dd), old)


@query(
    "unused_groups",
    sql("dd", """select distinct CountryCode, Currency, BranchId from dd t where not exists (
        select 1 from dd h where h.CountryCode = t.CountryCode and h.Currency = t.Currency
        and h.BranchId = t.BranchId and h.Currency = 'ZMW')"""),
)
def _(spark, sf):
    dd = staged(demand_daily(spark, sf), "history")
    return unused_groups(scaling_params(dd), dd.where("Currency = 'ZMW'"))


@query("scaling_json_roundtrip", sql("dd params_dd", f"select {FIELDS} from params_dd"))
def _(spark, sf):
    lines = params_to_json(scaling_params(staged(demand_daily(spark, sf), "history")))
    return rounded(params_from_json(lines), 4)


@query(
    "scaling_metadata",
    sql("dd params_dd", """select CountryCode, Currency, BranchId, 'StandardScaler' as scaling_method,
        'Currency-Branch' as scaling_level, 'Demand' as scaled_column,
        '2024-01-01T00:00:00' as generated_at, round(mean, 4) as mean, round(std, 4) as std,
        round(min, 4) as min, round(max, 4) as max from params_dd"""),
)
def _(spark, sf):
    lines = scaling_metadata(scaling_params(staged(demand_daily(spark, sf), "history")), "2024-01-01T00:00:00")
    return rounded(metadata_rows(lines), 4)
