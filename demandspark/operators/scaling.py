"""Per-group scaling parameters and z-scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.columns import safe_scale
from demandspark.operators.validate import refuse
from demandspark.sources.params import PARAM_FIELDS
from demandspark.spec import DATE, DEMAND, PRODUCT, SCALING_KEYS
from demandspark.staging import staged


def scaling_params(df: DataFrame, keys: Sequence[str] = SCALING_KEYS, value: str = DEMAND) -> DataFrame:
    """Mean, sample deviation, range, last value and count per group; staged, one row per group.

    The last value is that of the latest date; among its rows the highest product id
    decides. Text cannot be kept in a hash aggregate's buffer, and sorting all rows for
    the sake of one value would cost more than reading them again: the first pass keeps
    numbers and dates only, the second looks at the rows of each group's latest date.
    """
    moments = staged(
        df.groupBy(*keys).agg(
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.max(DATE).alias(DATE),
            F.count("*").alias("n_observations"),
        ),
        "moments",
    )
    newest = df.join(moments.select(*keys, DATE), [*keys, DATE], "left_semi")
    last = newest.groupBy(*keys).agg(F.max_by(value, PRODUCT).alias("last_value"))
    params = moments.join(last, list(keys), "left").select(*keys, *PARAM_FIELDS)
    return staged(params, "params")


def apply_scaling(
    df: DataFrame, params: DataFrame, keys: Sequence[str] = SCALING_KEYS, value: str = DEMAND
) -> DataFrame:
    """z-score within the group; rows of groups without parameters stay as they are."""
    p = _renamed(params, keys)
    scaled = (F.col(value) - F.col("_mean")) / safe_scale(F.col("_std"))
    return (
        df.join(p, list(keys), "left")
        .withColumn(value, F.when(F.col("_known"), scaled).otherwise(F.col(value)))
        .select(*df.columns)
    )


def inverse_scaling(
    df: DataFrame, params: DataFrame, values: Sequence[str], keys: Sequence[str] = SCALING_KEYS
) -> DataFrame:
    """Undo ``apply_scaling`` on every named column in one pass."""
    p = _renamed(params, keys)
    restored = {
        v: F.when(
            F.col("_known"), F.col(v) * safe_scale(F.col("_std")) + F.col("_mean")
        ).otherwise(F.col(v))
        for v in values
    }
    return df.join(p, list(keys), "left").withColumns(restored).select(*df.columns)


def _renamed(params: DataFrame, keys: Sequence[str]) -> DataFrame:
    return params.select(
        *keys, F.col("mean").alias("_mean"), F.col("std").alias("_std"), F.lit(True).alias("_known")
    )


def missing_groups(template: DataFrame, params: DataFrame, keys: Sequence[str] = SCALING_KEYS) -> DataFrame:
    """Groups of the template that have no parameters."""
    return template.select(*keys).distinct().join(params, list(keys), "left_anti")


def unused_groups(params: DataFrame, forecasts: DataFrame, keys: Sequence[str] = SCALING_KEYS) -> DataFrame:
    """Groups with parameters but without any forecast row."""
    return params.select(*keys).join(forecasts.select(*keys).distinct(), list(keys), "left_anti")


def scaling_violations(params: DataFrame, keys: Sequence[str] = SCALING_KEYS) -> DataFrame:
    """One row per group and broken rule."""
    def broken(condition, rule):
        return F.when(condition, F.lit(rule))

    # A single observation has no deviation, so a null std is an error only above one.
    absent = [F.col(c).isNull() for c in PARAM_FIELDS if c not in ("std", "n_observations")]
    any_absent = F.col("n_observations").isNull() | (
        F.col("std").isNull() & (F.coalesce("n_observations", F.lit(0)) > 1)
    )
    for a in absent:
        any_absent = any_absent | a
    key_absent = F.lit(False)
    for k in keys:
        key_absent = key_absent | F.col(k).isNull()
    rules = F.array(
        broken(key_absent, "null_key"),
        broken(any_absent, "missing_field"),
        broken(F.col("std") < 0, "negative_std"),
        broken(F.col("max") < F.col("min"), "max_below_min"),
        broken(F.col("n_observations") <= 0, "no_observations"),
    )
    return params.select(*keys, F.explode(F.array_compact(rules)).alias("rule"))


def validated_params(params: DataFrame, keys: Sequence[str] = SCALING_KEYS) -> DataFrame:
    """Fail on empty or incoherent parameters."""
    if params.isEmpty():
        raise ValueError("scaling parameters are empty")
    refuse(scaling_violations(params, keys), "invalid scaling parameters")
    return params


def require_groups(template: DataFrame, params: DataFrame, keys: Sequence[str] = SCALING_KEYS) -> None:
    refuse(missing_groups(template, params, keys), "no scaling parameters for")
