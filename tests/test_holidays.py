"""Holiday rules against the calendar walked day by day."""

from datetime import date, timedelta

from dateutil.easter import easter
from pyspark.sql import functions as F

from demandspark.operators.holidays import RULES_SCHEMA, easter_sunday, holiday_calendar
from demandspark.operators.prepare import flag_holidays
from tests.helpers import A, demand


def walk(year):
    d = date(year, 1, 1)
    while d.year == year:
        yield d
        d += timedelta(days=1)


def test_easter_of_600_years(spark):
    years = spark.range(1700, 2300).select(F.col("id").cast("int").alias("y"))
    for y, found in years.select("y", easter_sunday(F.col("y"))).collect():
        assert found == easter(y)


def test_rules_over_the_years(spark):
    rules = [
        ("ZM", "leap", "fixed", 2, 29, None, None, None),
        ("ZM", "third", "weekday", 8, None, 3, 3, "none"),
        ("ZM", "fifth", "weekday", 5, None, 1, 5, "none"),
        ("ZA", "last but one", "weekday", 10, None, 7, -2, "none"),
        ("ZA", "moved", "fixed", 5, 1, None, None, "monday"),
        ("ZA", "near", "fixed", 12, 25, None, None, "nearest"),
        ("ZA", "odd", "lunar", 1, 1, None, None, "none"),
    ]
    want = set()
    for y in range(1990, 2036):
        days = list(walk(y))
        of = lambda m, w: [d for d in days if d.month == m and d.isoweekday() == w]
        want |= {("ZM", d, "leap", d) for d in days if (d.month, d.day) == (2, 29)}
        want.add(("ZM", of(8, 3)[2], "third", of(8, 3)[2]))
        want |= {("ZM", d, "fifth", d) for d in of(5, 1)[4:5]}
        want.add(("ZA", of(10, 7)[-2], "last but one", of(10, 7)[-2]))
        may, xmas = date(y, 5, 1), date(y, 12, 25)
        want.add(("ZA", may + timedelta(days={6: 2, 7: 1}.get(may.isoweekday(), 0)), "moved", may))
        want.add(("ZA", xmas + timedelta(days={6: -1, 7: 1}.get(xmas.isoweekday(), 0)), "near", xmas))
    got = [tuple(r) for r in holiday_calendar(spark.createDataFrame(rules, RULES_SCHEMA), 1990, 2035).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_calendar_flags_history(spark):
    rules = spark.createDataFrame([("ZM", "second", "fixed", 1, 2, None, None, "none")], RULES_SCHEMA)
    flagged = flag_holidays(demand(spark, {A: [1, 2, 3]}), holiday_calendar(rules, 2023, 2024))
    assert [r["Demand"] for r in flagged.where("IsHoliday").collect()] == [2.0]
