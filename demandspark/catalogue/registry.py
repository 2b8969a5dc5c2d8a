"""Names to Spark callables and to oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparison; all double columns when none is named."""
    names = columns or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in names})
