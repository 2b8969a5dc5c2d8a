"""Demand, template and result tables in CSV or Parquet."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.columns import to_day, to_number
from demandspark.operators.validate import require_columns
from demandspark.spec import BRANCH, COUNTRY, CURRENCY, DATE, DEMAND, PRODUCT, SERIES_KEYS

# What happens when the target already exists.
WRITE_POLICIES = {"skip": "ignore", "raise": "errorifexists", "overwrite": "overwrite"}


def partition_names(files: Sequence[str]) -> list[str]:
    """Names of the ``name=value`` folders on the way to ``files``, outermost first."""
    return list(dict.fromkeys(x.split("=", 1)[0] for f in files for x in f.split("/")[:-1] if "=" in x))


def _headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """(file, first line) of every file that has one, found in one job whatever their number.

    The tasks that own the beginning of a file find its first line: rows of a task come in
    file order, so that is the line with the smallest id.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(list(paths))
    meta = lines.metadataColumn("_metadata")
    first = lines.select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), "value", F.monotonically_increasing_id().alias("id")
    ).where("start = 0")
    found = first.groupBy("file").agg(F.min_by("value", "id").alias("line")).collect()
    return sorted((unquote(r.file), r.line) for r in found)  # the scan needs the names on the driver


def _base(file: str) -> str:
    """The folder that holds the outermost ``name=value`` folder of ``file``."""
    parts = file.split("/")[:-1]
    return "/".join(parts[: next(i for i, x in enumerate(parts) if "=" in x)])


def read_text_columns(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Header CSV with every column as text, partition folders included.

    Columns are matched by name: each file is read by its own header. Files with equal
    headers are one scan; a file that lacks a column has nulls there. Folders are read with
    all files below them.

    The headers cost one pass over the lines. ``columns`` saves it where all files have that
    header; reading a file with another one fails.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    if columns is not None:
        files = spark.read.text(listed).inputFiles()
        return _scan(spark, columns, partition_names(files), listed)
    scans: dict[tuple, list[str]] = {}
    for file, line in _headers(spark, listed):
        folders = partition_names([file])
        base = _base(file) if folders else None
        if header := tuple(_header_fields(line)):
            scans.setdefault((header, base, *folders), []).append(file)
    frames = [_scan(spark, header, folders, files, base) for (header, base, *folders), files in scans.items()]
    if not frames:
        return spark.read.option("header", True).csv(listed)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _scan(
    spark: SparkSession, columns: Sequence[str], folders: Sequence[str], paths: Sequence[str], base: str | None = None
) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *folders]])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return (reader.option("basePath", base) if base else reader).csv(list(paths))


def _header_fields(line: str) -> list[str]:
    return next(csv.reader([line.removeprefix("\ufeff")]))


def _read_text_keys(spark: SparkSession, paths: str | Sequence[str], fmt: str) -> DataFrame:
    """Typed files, with partition folders as text: ``012`` is a key, not a number."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.format(fmt).load(listed)
    folders = partition_names(df.inputFiles())
    if not folders:
        return df
    fields = [T.StructField(f.name, T.StringType()) if f.name in folders else f for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).format(fmt).load(listed)


def read_demand(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    required: Sequence[str] = (PRODUCT, BRANCH, CURRENCY, DATE, DEMAND),
    country: str | None = None,
    country_from_file: bool = False,
    date_formats: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Demand rows of one or many files; keys as text, dates as days, demand as double.

    Files of one country that do not name it get it from ``country``, or from their file
    name up to its first dot or underscore (``country_from_file``). ``date_formats`` are
    tried in order before ISO dates. A cell that does not parse becomes null, so
    ``assert_no_nulls`` reports it. ``columns`` is the header of all files, if known: it
    saves the pass over their lines that finds it.
    """
    df = read_text_columns(spark, paths, columns) if fmt == "csv" else _read_text_keys(spark, paths, fmt)
    require_columns(df, required)
    if COUNTRY not in df.columns and (country is not None or country_from_file):
        name = F.element_at(F.split(F.input_file_name(), "/"), -1)
        df = df.withColumn(COUNTRY, F.lit(country) if country is not None else F.regexp_extract(name, r"^([^._]*)", 1))
    typed = {k: F.col(k).cast("string") for k in SERIES_KEYS if k in df.columns}
    if DATE in df.columns:
        typed[DATE] = to_day(F.col(DATE), date_formats)
    if DEMAND in df.columns:
        typed[DEMAND] = to_number(F.col(DEMAND))
    return df.withColumns(typed)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """Series to forecast, one row each, keys as text."""
    df = read_text_columns(spark, path)
    require_columns(df, [PRODUCT, BRANCH, CURRENCY])
    return df.withColumns({k: F.col(k).cast("string") for k in SERIES_KEYS if k in df.columns})


def write_table(
    df: DataFrame,
    path: str,
    policy: str = "raise",
    fmt: str = "csv",
    partition_by: Sequence[str] = (),
) -> None:
    """Write without an index column; ``policy`` is skip, raise or overwrite."""
    writer = df.write.mode(WRITE_POLICIES[policy])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_run(df: DataFrame, path: str, run_ts: str, policy: str = "raise", fmt: str = "parquet") -> None:
    """Results laid out by country and run, so one country or run is read without the rest."""
    write_table(df.withColumn("run_ts", F.lit(run_ts)), path, policy, fmt, (COUNTRY, "run_ts"))


def partition_schema(df: DataFrame, *last: str) -> T.StructType:
    """Schema of ``df`` with the partition columns moved to the end, as files hold them."""
    fields = [f for f in df.schema.fields if f.name not in last]
    return T.StructType(fields + [df.schema[c] for c in last])
