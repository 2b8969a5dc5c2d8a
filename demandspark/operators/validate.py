"""Checks that raise; each runs at most one job and brings back a bounded result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.spec import DATE, SERIES_KEYS
from demandspark.staging import staging_path


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail with the missing names; no job."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: nulls per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = null_counts(df, columns).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"missing values: {bad}")
    return df


def assert_dates(df: DataFrame, column: str = DATE) -> DataFrame:
    """Fail when a date could not be parsed (and so became null)."""
    if not df.where(F.col(column).isNull()).limit(1).isEmpty():
        raise ValueError(f"some '{column}' entries could not be parsed as dates")
    return df


def assert_daily_grain(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, date: str = DATE) -> DataFrame:
    """Fail when a series has two rows for one day.

    Window operators rely on this grain: it bounds a series by the calendar, however
    large its share of the raw rows was.
    """
    refuse(df.groupBy(*keys, date).count().where("count > 1"), "more than one row per series and day")
    return df


def refuse(violations: DataFrame, message: str) -> None:
    """Fail if there is a row: with their number, the path of the whole table, and the first few."""
    path = staging_path(violations.sparkSession, "violations")
    violations.write.parquet(path)
    found = violations.sparkSession.read.schema(violations.schema).parquet(path)
    n = found.count()
    if n:
        raise ValueError(f"{message}: {n} rows, all in {path}: {[r.asDict() for r in found.take(20)]}")
