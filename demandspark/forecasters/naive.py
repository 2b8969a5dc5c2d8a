"""Last value of the same weekday, with a band from its past misses."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.columns import interpolated, weekday_name
from demandspark.operators.grid import carry_forward
from demandspark.spec import DATE, DEMAND, TARGET_DATE, WEEKDAY, ForecastSpec


@dataclass(frozen=True)
class SeasonalNaive:
    """Middle quantile: last demand on the weekday. Others: plus residual quantiles.

    A residual is the change from the weekday's previous row; the last
    ``weekday_weeks`` of them count.
    """

    spec: ForecastSpec = field(default_factory=ForecastSpec)
    name: str = "seasonal_naive"
    lookback_days: int | None = None
    needs_target: bool = True

    def fit(self, history: DataFrame) -> DataFrame:
        q = self.spec.quantiles
        by_weekday = Window.partitionBy(*self.spec.keys, WEEKDAY).orderBy(DATE)
        recent = by_weekday.rowsBetween(-(self.spec.weekday_weeks - 1), Window.currentRow)
        residual = F.col(DEMAND) - F.lag(DEMAND).over(by_weekday)
        misses = F.sort_array(F.collect_list("_residual").over(recent))
        level = F.last(DEMAND, ignorenulls=True).over(
            by_weekday.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        shifted = [
            (F.col("_level") if n == q.mid else F.col("_level") + interpolated(F.col("_misses"), p)).alias(n)
            for n, p in q.levels
        ]
        return (
            history.select(*self.spec.keys, DATE, DEMAND, weekday_name(F.col(DATE)).alias(WEEKDAY))
            .withColumn("_residual", residual)
            .withColumns({"_misses": misses, "_level": level})
            .select(*self.spec.keys, WEEKDAY, DATE, *shifted)
        )

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame:
        requests = grid.withColumn(WEEKDAY, weekday_name(F.col(TARGET_DATE)))
        scored = carry_forward(
            requests, params, [*self.spec.keys, WEEKDAY], self.spec.quantiles.names
        )
        return scored.select(*grid.columns, *self.spec.quantiles.names)
