"""Quantiles of a series' last rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.columns import interpolated
from demandspark.operators.grid import carry_forward
from demandspark.spec import DATE, DEMAND, ForecastSpec


@dataclass(frozen=True)
class TrailingQuantile:
    """Quantiles of the last ``trailing_rows`` demands, carried until the next row."""

    spec: ForecastSpec = field(default_factory=ForecastSpec)
    name: str = "trailing_quantile"
    lookback_days: int | None = None
    needs_target: bool = False

    def fit(self, history: DataFrame) -> DataFrame:
        q = self.spec.quantiles
        rows = (
            Window.partitionBy(*self.spec.keys).orderBy(DATE)
            .rowsBetween(-(self.spec.trailing_rows - 1), Window.currentRow)
        )
        # At most trailing_rows values per frame, sorted once for all quantiles.
        recent = F.sort_array(F.collect_list(DEMAND).over(rows))
        return history.select(*self.spec.keys, DATE, recent.alias("_recent")).select(
            *self.spec.keys, DATE, *[interpolated(F.col("_recent"), p).alias(n) for n, p in q.levels]
        )

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame:
        return carry_forward(grid, params, self.spec.keys, self.spec.quantiles.names)
