"""Small literal frames."""

from datetime import date, timedelta

SERIES = "ProductId string, BranchId string, CountryCode string, Currency string"
DEMAND_SCHEMA = SERIES + ", EffectiveDate date, Demand double"


def day(n: int) -> date:
    return date(2024, 1, 1) + timedelta(days=n)


def demand(spark, series: dict[tuple, list], start: int = 0):
    """``series`` maps (product, branch, country, currency) to demands of consecutive days; ... skips a day."""
    rows = [
        (*key, day(start + i), None if v is None else float(v))
        for key, values in series.items()
        for i, v in enumerate(values)
        if v is not ...
    ]
    return spark.createDataFrame(rows, DEMAND_SCHEMA)


def rows(df, *columns):
    """Sorted tuples of the named columns."""
    return sorted(
        (tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((x is None, str(x)) for x in t)
    )


A = ("18", "11", "ZM", "USD")
B = ("7", "11", "ZM", "USD")
C = ("18", "12", "ZA", "ZAR")
