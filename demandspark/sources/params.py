"""Scaling parameters, scaling metadata and statistics reports as JSON.

One JSON object per line and group, so no line grows with the number of groups. The
readers explode the maps, so a single object that holds many groups reads the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators.validate import refuse
from demandspark.spec import BRANCH, COUNTRY, CURRENCY, DEMAND, ForecastSpec

# Field names, key separators and texts of the JSON forms.
PARAM_FIELDS = ("mean", "std", "min", "max", "last_value", "n_observations")
PARAM_TYPE = (
    "struct<mean:double,std:double,min:double,max:double,last_value:double,n_observations:bigint>"
)
STATS_TYPE = "struct<mean:double,std:double,min:double,max:double>"
PARAMS_SEPARATOR = "_"
METADATA_SEPARATOR = "-"
METADATA_KEYS = (
    "scaling_method", "scaling_level", "scaled_column", "scaling_stats", "generated_at", "country_code",
)
SCALING_METHOD = "StandardScaler"
SCALING_LEVEL = "Currency-Branch"


def params_to_json(params: DataFrame) -> DataFrame:
    """``{"CUR_BRANCH": {mean, std, ...}}`` in column ``value``, with the country beside it."""
    key = F.concat_ws(PARAMS_SEPARATOR, CURRENCY, BRANCH)
    entry = F.create_map(key, F.struct(*PARAM_FIELDS))
    return params.select(COUNTRY, F.to_json(entry).alias("value"))


def params_from_json(lines: DataFrame) -> DataFrame:
    """Parameter rows of the JSON objects in ``value``; other columns are kept.

    The key is cut at the first separator only, so branch ids may contain it.
    """
    kept = [c for c in lines.columns if c != "value"]
    parsed = F.from_json("value", f"map<string,{PARAM_TYPE}>")
    cut = F.split("key", PARAMS_SEPARATOR, 2)
    return lines.select(*kept, F.explode(parsed).alias("key", "p")).select(
        *kept, cut[0].alias(CURRENCY), cut[1].alias(BRANCH), "p.*"
    )


def write_params_json(params: DataFrame, path: str, mode: str = "errorifexists") -> None:
    params_to_json(params).write.mode(mode).partitionBy(COUNTRY).text(path)


def read_params_json(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """``whole_files`` is for indented objects, one file per country."""
    schema = f"value string, {COUNTRY} string"  # folder names are text
    return params_from_json(spark.read.schema(schema).text(path, wholetext=whole_files))


def scaling_metadata(params: DataFrame, generated_at: str, method: str = SCALING_METHOD) -> DataFrame:
    """Metadata documents in column ``value``, one per group."""
    key = F.concat_ws(METADATA_SEPARATOR, CURRENCY, BRANCH)
    document = F.struct(
        F.lit(method).alias("scaling_method"),
        F.lit(SCALING_LEVEL).alias("scaling_level"),
        F.lit(DEMAND).alias("scaled_column"),
        F.create_map(key, F.struct("mean", "std", "min", "max")).alias("scaling_stats"),
        F.lit(generated_at).alias("generated_at"),
        F.col(COUNTRY).alias("country_code"),
    )
    return params.select(F.to_json(document).alias("value"))


def metadata_rows(lines: DataFrame) -> DataFrame:
    """Flatten metadata documents; a document without a required key fails."""
    present = F.json_object_keys("value")
    required = F.array(*[F.lit(k) for k in METADATA_KEYS])
    missing = lines.select(F.array_except(required, F.coalesce(present, F.array())).alias("missing"))
    refuse(missing.where(F.size("missing") > 0), "scaling metadata lacks required keys")
    schema = (
        "scaling_method string, scaling_level string, scaled_column string, "
        f"scaling_stats map<string,{STATS_TYPE}>, generated_at string, country_code string"
    )
    cut = F.split("key", METADATA_SEPARATOR, 2)
    return (
        lines.select(F.from_json("value", schema).alias("m")).select("m.*")
        .select(
            "scaling_method", "scaling_level", "scaled_column", "generated_at",
            F.col("country_code").alias(COUNTRY), F.explode("scaling_stats").alias("key", "s"),
        )
        .select(
            COUNTRY, cut[0].alias(CURRENCY), cut[1].alias(BRANCH),
            "scaling_method", "scaling_level", "scaled_column", "generated_at", "s.*",
        )
    )


def stats_report(
    described: DataFrame, flags: DataFrame, params: DataFrame, spec: ForecastSpec = ForecastSpec()
) -> DataFrame:
    """Nested report, one document per scaling group.

    ``described`` has one row per (group, quantile) with describe columns, outlier and
    negative counts; ``flags`` one row per group with its validation flags. A group has
    as many quantile rows as there are quantiles, so the collected map stays small.
    """
    keys = list(spec.scaling_keys)
    basic = F.struct("count", "mean", "std", "min", "`25%`", "`50%`", "`75%`", "max")
    per_quantile = described.groupBy(*keys).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    "quantile",
                    F.struct(basic.alias("basic_stats"), "outliers", "negative_values"),
                )
            )
        ).alias("quantile_stats"),
        F.max("n_rows").alias("n_forecasts"),
    )
    return (
        per_quantile.join(
            flags.select(
                *keys, F.struct("negative_values", "extreme_outliers").alias("validation")
            ),
            keys,
        )
        .join(params.select(*keys, F.struct(*PARAM_FIELDS).alias("scaling_params")), keys)
        .select(*keys, "n_forecasts", "scaling_params", "quantile_stats", "validation")
    )


def global_stats(forecasts: DataFrame, run_ts: str, method: str, spec: ForecastSpec) -> DataFrame:
    """The report's header: one row for the whole run."""
    return forecasts.agg(F.count("*").alias("total_forecasts")).select(
        "total_forecasts",
        F.lit(run_ts).alias("timestamp"),
        F.lit(method).alias("scaling_method"),
        F.lit(spec.horizon).alias("forecast_horizon"),
        F.lit(",".join(spec.quantiles.names)).alias("quantiles"),
    )
