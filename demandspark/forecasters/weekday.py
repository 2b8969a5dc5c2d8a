"""Quantiles of the same weekday over the last weeks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.columns import interpolated
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec

SLOT = "SlotDate"


def weekday_slot(target: Column, origin: Column) -> Column:
    """Latest date at or before the origin that shares the target's weekday."""
    weeks = F.ceil(F.datediff(target, origin) / F.lit(7)).cast("int")
    return F.date_sub(target, weeks * 7)


@dataclass(frozen=True)
class WeekdayQuantile:
    """Quantiles of demand on the target's weekday in the ``weekday_weeks`` weeks up to the origin.

    Those are the days slot, slot-7, ... for the latest such date ("slot"). Each history
    row is handed to the slots it serves, so a slot is one small group and a grid row
    finds it by equality - no range join and no pairing of origins with history.
    """

    spec: ForecastSpec = field(default_factory=ForecastSpec)
    name: str = "weekday_quantile"
    needs_target: bool = True

    @property
    def lookback_days(self) -> int:
        return 7 * self.spec.weekday_weeks

    def fit(self, history: DataFrame) -> DataFrame:
        q, weeks = self.spec.quantiles, self.spec.weekday_weeks
        served = F.transform(
            F.sequence(F.lit(0), F.lit(weeks - 1)), lambda k: F.date_add(F.col(DATE), (k * 7).cast("int"))
        )
        # At most weekday_weeks values per slot at daily grain, sorted once for all quantiles.
        values = F.sort_array(F.collect_list(DEMAND))
        return (
            history.select(*self.spec.keys, DEMAND, F.explode(served).alias(SLOT))
            .groupBy(*self.spec.keys, SLOT)
            .agg(values.alias("_values"))
            .select(
                *self.spec.keys, SLOT, *[interpolated(F.col("_values"), p).alias(n) for n, p in q.levels]
            )
        )

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame:
        slotted = grid.withColumn(SLOT, weekday_slot(F.col(TARGET_DATE), F.col(DATE)))
        # The planner does not count exploded rows: a plain join could broadcast a large
        # slot table for the sake of its small source.
        return slotted.join(params.hint("merge"), [*self.spec.keys, SLOT], "left").select(
            *grid.columns, *self.spec.quantiles.names
        )
