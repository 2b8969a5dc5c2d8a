"""From raw demand rows to typed, repaired, daily series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.columns import log_demand, to_day, to_number, weekday_name
from demandspark.operators.validate import assert_daily_grain, null_counts, require_columns
from demandspark.spec import (
    COUNTRY, COUNTRY_NAME, COUNTRY_NAMES, DATE, DEMAND, SERIES_KEYS, WEEKDAY,
)
from demandspark.staging import staged


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Required columns in the given order."""
    return require_columns(df, columns).select(*columns)


def keys_as_string(df: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    return df.withColumns({k: F.col(k).cast("string") for k in keys if k in df.columns})


def prefix_keys(df: DataFrame, prefixes: Mapping[str, str]) -> DataFrame:
    """Put a text prefix before each named key."""
    require_columns(df, list(prefixes))
    return df.withColumns(
        {c: F.concat(F.lit(p), F.col(c).cast("string")) for c, p in prefixes.items()}
    )


def add_missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Null columns of the given types where a name is absent."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def country_name(code: Column, names: Mapping[str, str] = COUNTRY_NAMES) -> Column:
    """Name of a country code, null when unknown."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.try_element_at(table, code)


def add_calendar(df: DataFrame, date: str = DATE, names: Mapping[str, str] = COUNTRY_NAMES) -> DataFrame:
    """Weekday name of ``date`` and country name."""
    added = {WEEKDAY: weekday_name(F.col(date))}
    if COUNTRY in df.columns:
        added[COUNTRY_NAME] = country_name(F.col(COUNTRY), names)
    return df.withColumns(added)


def prepare_demand(df: DataFrame, required: Sequence[str] | None = None, daily: bool = False) -> DataFrame:
    """Checked and typed demand: required columns only, keys as text, dates as days.

    One job counts missing cells and unreadable dates together. ``daily`` also checks
    for one row per series and day, which the window operators rely on.
    """
    required = list(required or [*SERIES_KEYS, DATE, DEMAND])
    raw = project(df, required)
    typed = keys_as_string(raw).withColumns({DATE: to_day(F.col(DATE)), DEMAND: to_number(F.col(DEMAND))})
    unreadable = raw.select(*required, to_day(F.col(DATE)).alias("_day"))
    counts = null_counts(unreadable, [*required, "_day"]).first().asDict()
    no_day = counts.pop("_day")
    missing = {c: n for c, n in counts.items() if n}
    if missing:
        raise ValueError(f"missing values: {missing}")
    if no_day:
        raise ValueError(f"{no_day} '{DATE}' entries could not be parsed as dates")
    return assert_daily_grain(typed, [k for k in SERIES_KEYS if k in required]) if daily else typed


def demand_signs(df: DataFrame, keys: Sequence[str] = (COUNTRY,)) -> DataFrame:
    """Zero and negative counts and the smallest positive demand."""
    d = F.col(DEMAND)
    return df.groupBy(*keys).agg(
        F.count_if(d == 0).alias("n_zero"),
        F.count_if(d < 0).alias("n_negative"),
        F.min(F.when(d > 0, d)).alias("min_positive"),
    )


# Share of the smallest positive demand, and the value where there is none.
REPAIR_SHARE = 0.01
REPAIR_DEFAULT = 0.01


def repair_nonpositive(df: DataFrame, keys: Sequence[str] = (COUNTRY,)) -> DataFrame:
    """Replace demand <= 0 by a small positive value of its country; nulls stay."""
    floors = staged(demand_signs(df, keys).select(*keys, "min_positive"), "floors")
    small = F.coalesce(F.col("min_positive") * REPAIR_SHARE, F.lit(REPAIR_DEFAULT))
    repaired = F.when(F.col(DEMAND) <= 0, small).otherwise(F.col(DEMAND))
    return df.join(floors, list(keys), "left").withColumn(DEMAND, repaired).select(*df.columns)


def log_transform(df: DataFrame) -> DataFrame:
    return df.withColumn(DEMAND, log_demand(F.col(DEMAND)))


def series_template(df: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Distinct series."""
    return df.select(*keys).distinct()


def keep_one(
    df: DataFrame, order: Column, keep: str = "last", keys: Sequence[str] = (*SERIES_KEYS, DATE)
) -> DataFrame:
    """One whole row per key, the first or last by ``order``.

    An aggregate rather than a row number: candidates are reduced before the shuffle,
    so a key with very many copies never gathers in one task.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    pick = F.max_by(row, order) if keep == "last" else F.min_by(row, order)
    return df.groupBy(*keys).agg(pick.alias("_row")).select("_row.*")


def train_future_split(df: DataFrame, steps: int, keys: Sequence[str] = (COUNTRY,)) -> DataFrame:
    """Tag rows ``train`` or ``future`` by a cutoff ``steps`` days before the country's last date."""
    cutoffs = staged(
        df.groupBy(*keys).agg(F.date_sub(F.max(DATE), steps).alias("Cutoff")), "cutoffs"
    )
    part = F.when(F.col(DATE) <= F.col("Cutoff"), "train").otherwise("future")
    return df.join(cutoffs, list(keys)).withColumn("part", part)


def date_range(df: DataFrame, keys: Sequence[str] = (COUNTRY,)) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"))


def flag_holidays(df: DataFrame, holidays: DataFrame, date: str = DATE) -> DataFrame:
    """``IsHoliday`` from a (CountryCode, date, holiday) table with one row per holiday."""
    days = holidays.select(
        F.col(COUNTRY), F.col("date").alias(date), F.lit(True).alias("_hit")
    ).distinct()
    return (
        df.join(days, [COUNTRY, date], "left")
        .withColumn("IsHoliday", F.coalesce("_hit", F.lit(False)))
        .select(*df.columns, "IsHoliday")
    )
