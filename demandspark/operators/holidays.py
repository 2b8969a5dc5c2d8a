"""Holiday dates of many countries and years from a table of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.spec import COUNTRY

# Columns of a rule table. ``kind``: fixed (month, day), weekday (``nth`` ISO ``weekday`` of
# ``month``; -1 is the last) or easter (``day`` days after Easter Sunday). ``observed``: none,
# monday (a date on a weekend moves to the Monday after) or nearest (Saturday to Friday,
# Sunday to Monday).
RULES_SCHEMA = (
    f"{COUNTRY} string, holiday string, kind string, month int, day int, weekday int, nth int, observed string"
)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter: the Sunday after the ecclesiastical full moon, in whole numbers."""
    def whole(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    golden, century = year % 19, whole(year, 100)
    # Age of the moon at the end of March, with the corrections for leap years dropped and the moon's own drift.
    epact = F.pmod(century - whole(century, 4) - whole(8 * century + 13, 25) + 19 * golden + 15, F.lit(30))
    late = (epact == 29) | ((epact == 28) & (golden > 10))
    full_moon = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), (epact - late.cast("int")).cast("int"))
    return F.next_day(full_moon, "Sun")


def nth_weekday(year: Column, month: Column, weekday: Column, nth: Column) -> Column:
    """The ``nth`` ISO ``weekday`` (1 is Monday) of a month, counted from its end where negative; null if there is none."""
    first = F.make_date(year, month, F.lit(1))
    last = F.last_day(first)
    ahead = F.pmod(weekday - 1 - F.weekday(first), F.lit(7)) + 7 * (nth - 1)
    back = F.pmod(F.weekday(last) - (weekday - 1), F.lit(7)) + 7 * (-nth - 1)
    found = F.when(nth > 0, F.date_add(first, ahead.cast("int"))).when(nth < 0, F.date_sub(last, back.cast("int")))
    return F.when(F.month(found) == month, found)


def _observed(date: Column, rule: Column) -> Column:
    day = F.weekday(date)  # 5 is Saturday
    after = F.date_add(date, (7 - day).cast("int"))
    return (
        F.when((rule == "monday") & (day >= 5), after)
        .when((rule == "nearest") & (day == 5), F.date_sub(date, 1))
        .when((rule == "nearest") & (day == 6), F.date_add(date, 1))
        .otherwise(date)
    )


def holiday_calendar(rules: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """One row per rule and year: CountryCode, date, holiday, ``actual`` (the date before it moves).

    ``flag_holidays`` takes the result as it is. A rule without a date in a year (29 February,
    a fifth Monday) has no row for it; an unknown ``kind`` has none at all.
    """
    year = F.col("_year")
    fixed = F.when(
        F.col("day") <= F.day(F.last_day(F.make_date(year, F.col("month"), F.lit(1)))), F.make_date(year, "month", "day")
    )
    actual = (
        F.when(F.col("kind") == "fixed", fixed)
        .when(F.col("kind") == "weekday", nth_weekday(year, F.col("month"), F.col("weekday"), F.col("nth")))
        .when(F.col("kind") == "easter", F.date_add(easter_sunday(year), F.col("day")))
    )
    return (
        rules.withColumn("_year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
        .withColumn("actual", actual)
        .where("actual is not null")
        .select(COUNTRY, _observed(F.col("actual"), F.coalesce("observed", F.lit("none"))).alias("date"), "holiday", "actual")
    )
