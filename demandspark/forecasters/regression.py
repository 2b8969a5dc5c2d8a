"""One linear model for all series on as-of lags, weekday, holiday and lead."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.columns import interpolated, weekday_name
from demandspark.operators.grid import carry_forward
from demandspark.operators.prepare import flag_holidays
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec
from demandspark.staging import staged

# The weekdays with a dummy variable; the remaining one is the base.
DUMMY_WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


@dataclass(frozen=True)
class LagRegression:
    """Demand from the latest demand, the latest on the target's weekday, weekday, holiday, lead.

    Both lags are as of the origin, so every origin with a past has a forecast. History
    rows are seen from ``horizon`` leads, and the weights of a block of ``refit_days`` are
    ridge least squares on targets before the block, drawn towards the mean of the two
    lags: one map-side combined aggregate gives the normal equations of all blocks, which
    are as many as the calendar has blocks. Bands are quantiles of the last
    ``trailing_rows`` misses of a series at the same lead, known at the origin; each miss
    is that of its own block's weights. Nothing after an origin enters its forecast.
    ``ridge=None`` keeps the mean of the lags.
    """

    holidays: DataFrame | None = None
    spec: ForecastSpec = field(default_factory=ForecastSpec)
    name: str = "lag_regression"
    lookback_days: int | None = None
    needs_target: bool = True
    refit_days: int = 30
    ridge: float | None = 1e-3

    @property
    def features(self) -> list[str]:
        return ["one", "lag_day", "lag_week", "lead", "holiday", *[f"is_{d}" for d in DUMMY_WEEKDAYS]]

    @property
    def prior(self) -> list[float]:
        return [0.5 if f.startswith("lag_") else 0.0 for f in self.features]

    def _block(self, date: str) -> Column:
        return F.floor(F.unix_date(date) / F.lit(self.refit_days)).cast("long")

    def with_features(self, grid: DataFrame, history: DataFrame) -> DataFrame:
        """``grid`` (origin and target dates) with the features of each row; lags null before a series."""
        keys = list(self.spec.keys)
        known = history.where(F.col(DEMAND).isNotNull()).select(*keys, DATE, F.col(DEMAND).cast("double").alias("lag_day"))
        by_day = known.select(*keys, weekday_name(F.col(DATE)).alias("_weekday"), DATE, F.col("lag_day").alias("lag_week"))
        rows = grid.withColumn("_weekday", weekday_name(F.col(TARGET_DATE)))
        rows = carry_forward(rows, known, keys, ["lag_day"])
        rows = carry_forward(rows, by_day, [*keys, "_weekday"], ["lag_week"])
        rows = (
            flag_holidays(rows, self.holidays, TARGET_DATE) if self.holidays is not None
            else rows.withColumn("IsHoliday", F.lit(False))
        )
        return rows.select(
            *grid.columns, F.lit(1.0).alias("one"), "lag_day", F.coalesce("lag_week", "lag_day").alias("lag_week"),
            F.datediff(TARGET_DATE, DATE).cast("double").alias("lead"), F.col("IsHoliday").cast("double").alias("holiday"),
            *[(F.col("_weekday") == d).cast("double").alias(f"is_{d}") for d in DUMMY_WEEKDAYS],
        )

    def training_rows(self, history: DataFrame) -> DataFrame:
        """Each history row as the target of every lead, with its features and ``label``."""
        leads = F.explode(F.sequence(F.lit(1), F.lit(self.spec.horizon))).alias("_lead")
        grid = (
            history.where(F.col(DEMAND).isNotNull())
            .select(*self.spec.keys, F.col(DATE).alias(TARGET_DATE), F.col(DEMAND).cast("double").alias("label"), leads)
            .withColumn(DATE, F.date_sub(TARGET_DATE, (F.col("_lead") * self.spec.freq_days).cast("int")))
            .drop("_lead")
        )
        return self.with_features(grid, history).where("lag_day is not null")

    def _weights(self, rows: DataFrame) -> list[tuple[int, list[float]]]:
        """(first block, weights) in order; the first holds for all blocks before."""
        w0 = np.array(self.prior)
        if self.ridge is None:
            return [(-(1 << 40), w0.tolist())]
        names = self.features
        x = [F.col(n) for n in names]
        miss = F.col("label") - sum((F.lit(w) * c for w, c in zip(self.prior, x)), F.lit(0.0))
        sums = [F.sum(a * b) for i, a in enumerate(x) for b in x[: i + 1]] + [F.sum(a * miss) for a in x]
        # One row for each block of the calendar.
        found = rows.groupBy(self._block(TARGET_DATE).alias("b")).agg(F.array(*sums).alias("s")).orderBy("b").collect()
        n = len(names)
        gram, moment, out = np.zeros((n, n)), np.zeros(n), [(-(1 << 40), w0.tolist())]
        for r in found:
            s = np.array(r.s)
            lower = np.zeros((n, n))
            lower[np.tril_indices(n)] = s[: n * (n + 1) // 2]
            gram += lower + np.tril(lower, -1).T
            moment += s[n * (n + 1) // 2 :]
            scale = np.sqrt(np.maximum(np.diag(gram), 1.0))
            scaled = gram / np.outer(scale, scale) + self.ridge * np.eye(n)
            out.append((r.b + 1, (w0 + np.linalg.solve(scaled, moment / scale) / scale).tolist()))
        return out

    def _point(self, weights: list[tuple[int, list[float]]], known_by: str) -> Column:
        """Forecast by the newest weights that were fit before the block of ``known_by``."""
        table = F.array(*[F.struct(F.lit(b).alias("b"), F.array(*map(F.lit, w)).alias("w")) for b, w in weights])
        block = self._block(known_by)
        chosen = F.element_at(F.filter(table, lambda t: t["b"] <= block), -1)["w"]
        return F.aggregate(
            F.zip_with(chosen, F.array(*self.features), lambda w, v: w * v), F.lit(0.0), lambda total, v: total + v
        )

    def fit(self, history: DataFrame) -> DataFrame:
        """Recent demands (``kind`` demand), misses by lead (miss) and the weights of the blocks (weights)."""
        keys, q = list(self.spec.keys), self.spec.quantiles
        rows = staged(self.training_rows(history), "training-rows")
        weights = self._weights(rows)
        last = (
            Window.partitionBy(*keys, "lead").orderBy(TARGET_DATE)
            .rowsBetween(-(self.spec.trailing_rows - 1), Window.currentRow)
        )
        recent = F.sort_array(F.collect_list("_miss").over(last))
        misses = (
            rows.select(*keys, DATE, TARGET_DATE, "lead", (F.col("label") - self._point(weights, DATE)).alias("_miss"))
            .select(*keys, F.col(TARGET_DATE).alias(DATE), "lead", recent.alias("_recent"))
            .select(*keys, DATE, "lead", F.array(*[interpolated(F.col("_recent"), p) for _, p in q.levels]).alias("misses"))
        )
        demands = history.select(*keys, DATE, F.col(DEMAND).cast("double").alias(DEMAND))
        fitted = history.sparkSession.createDataFrame(weights, "block long, weights array<double>")
        return (
            demands.withColumn("kind", F.lit("demand"))
            .unionByName(misses.withColumn("kind", F.lit("miss")), allowMissingColumns=True)
            .unionByName(fitted.withColumn("kind", F.lit("weights")), allowMissingColumns=True)
        )

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame:
        keys, q = list(self.spec.keys), self.spec.quantiles
        params = staged(params, "lag-regression")
        found = params.where("kind = 'weights'").orderBy("block").select("block", "weights").collect()
        rows = self.with_features(grid, params.where("kind = 'demand'").select(*keys, DATE, DEMAND))
        scored = carry_forward(rows, params.where("kind = 'miss'").select(*keys, DATE, "lead", "misses"), [*keys, "lead"], ["misses"])
        point = self._point([(r.block, r.weights) for r in found], DATE)
        side = {n: F.coalesce(F.get("misses", F.lit(i)), F.lit(0.0)) for i, n in enumerate(q.names)}
        scored = scored.withColumn("_point", F.when(F.col("lag_day").isNotNull(), point))
        return scored.select(*grid.columns, *[(F.col("_point") + side[n]).alias(n) for n in q.names])
