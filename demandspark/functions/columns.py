"""Scalar column expressions; all run inside whole-stage codegen, none raises on bad cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandspark.spec import Quantiles


# A number as data files write it; a cast alone would also take suffixes such as 1.5d.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|(?i)^\s*[+-]?inf(inity)?\s*$"


def to_number(c: Column) -> Column:
    """Text to double, unparseable cells and NaN to null."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number) & c.cast("string").rlike(NUMBER), number)


def strip_quotes(c: Column) -> Column:
    """Drop surrounding blanks, then surrounding double quotes."""
    return F.btrim(F.btrim(c, F.lit(" \t\r\n")), F.lit('"'))


def strip_thousands(c: Column) -> Column:
    """Number written with thousands commas, as double."""
    return to_number(F.replace(c, F.lit(","), F.lit("")))


def to_day(c: Column, formats: Sequence[str] = ()) -> Column:
    """Day of a date, timestamp or text; an offset in the text is dropped, not applied.

    ``formats`` are date patterns tried in order before the ISO form.
    """
    tried = [F.try_to_date(c.cast("string"), f) for f in formats]
    return F.coalesce(*tried, c.try_cast("timestamp_ntz").cast("date"))


def weekday_name(c: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(c, "EEEE")


def log_demand(c: Column) -> Column:
    return F.log1p(c)


def unlog_demand(c: Column, passes: int = 1) -> Column:
    """Inverse of ``log_demand`` floored at zero; ``passes=2`` applies it twice."""
    for _ in range(passes):
        c = F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.expm1(c)))
    return c


def ordered_quantiles(quantiles: Quantiles) -> dict[str, Column]:
    """Low never above mid, high never below mid; a null side takes the other."""
    low, mid, high = (F.col(n) for n in (quantiles.low, quantiles.mid, quantiles.high))
    return {quantiles.low: F.least(low, mid), quantiles.high: F.greatest(mid, high)}


def forecast_day(target: Column, origin: Column, day_offset: int = 1) -> Column:
    return F.datediff(target, origin) + F.lit(day_offset)


def safe_scale(std: Column) -> Column:
    """Divisor for scaling: a zero standard deviation becomes one, null stays null."""
    return F.when(std == 0, F.lit(1.0)).otherwise(std)


def interpolated(values: Column, p: float) -> Column:
    """Linearly interpolated quantile of an ascending array column; null when empty."""
    position = (F.size(values) - 1) * F.lit(float(p))
    below = F.floor(position).cast("int")
    above = F.ceil(position).cast("int")
    lower = F.get(values, below)
    upper = F.get(values, above)
    return lower + (upper - lower) * (position - below)
