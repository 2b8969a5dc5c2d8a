"""Quantiles fitted as quantiles: one linear model for each level on the features of ``LagRegression``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.forecasters.regression import LagRegression
from demandspark.functions.quantile_fit import fit_quantiles
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec
from demandspark.staging import staged


@dataclass(frozen=True)
class QuantileRegression:
    """Each quantile is a linear function of the lags, weekday, holiday and lead, fitted by pinball loss.

    The weights that serve the origins of a block of ``refit_days`` are fitted on targets
    before the block, all blocks and levels in the same passes; nothing after an origin
    enters its forecast. Where no row came before, quantiles are null. Fitted quantiles
    that cross are put in order.
    """

    holidays: DataFrame | None = None
    spec: ForecastSpec = field(default_factory=ForecastSpec)
    name: str = "quantile_regression"
    lookback_days: int | None = None
    needs_target: bool = True
    refit_days: int = 180

    @property
    def _lags(self) -> LagRegression:
        return LagRegression(self.holidays, self.spec)

    @property
    def features(self) -> list[str]:
        return self._lags.features

    def _block(self, date: str) -> Column:
        return F.floor(F.unix_date(date) / F.lit(self.refit_days)).cast("long")

    def fit(self, history: DataFrame) -> DataFrame:
        """Demands (``kind`` demand) and the weights of each block and level (weights), as one table."""
        keys = list(self.spec.keys)
        rows = self._lags.training_rows(history).withColumn("block", self._block(TARGET_DATE))
        rows = staged(rows.select("block", "label", *self.features), "training-rows")
        first, last = rows.agg(F.min("block"), F.max("block")).first()
        starts = range(first, last + 2) if first is not None else []
        levels = self.spec.quantiles.probabilities
        found = fit_quantiles(rows, self.features, "label", levels, "block", starts)
        weights = history.sparkSession.createDataFrame(
            [(b, p, w) for (b, p), w in found.items()], "block long, level double, weights array<double>"
        )
        demands = history.where(F.col(DEMAND).isNotNull()).select(*keys, DATE, F.col(DEMAND).cast("double").alias(DEMAND))
        return demands.withColumn("kind", F.lit("demand")).unionByName(
            weights.withColumn("kind", F.lit("weights")), allowMissingColumns=True
        )

    def predict(self, params: DataFrame, grid: DataFrame) -> DataFrame:
        keys, q = list(self.spec.keys), self.spec.quantiles
        params = staged(params, "quantile-regression")
        models = params.where("kind = 'weights'").groupBy("block").agg(
            F.array_sort(F.collect_list(F.struct("level", "weights"))).alias("models")
        )
        # One row for each block of the calendar; the last serves all origins after it.
        models = staged(models.withColumnRenamed("block", "_block"), "block-weights")
        last = models.agg(F.max("_block")).first()[0]
        rows = self._lags.with_features(grid, params.where("kind = 'demand'").select(*keys, DATE, DEMAND))
        scored = rows.withColumn("_block", F.least(self._block(DATE), F.lit(last).cast("long"))).join(models, "_block", "left")
        values = F.array(*[F.col(f) for f in self.features])

        def fitted(model: Column) -> Column:
            terms = F.zip_with(model["weights"], values, lambda w, v: w * v)
            return F.aggregate(terms, F.lit(0.0), lambda total, v: total + v)

        known = F.when(F.col("lag_day").isNotNull(), F.array_sort(F.transform("models", fitted)))
        scored = scored.withColumn("_fits", known)
        return scored.select(*grid.columns, *[F.get("_fits", F.lit(i)).alias(n) for i, n in enumerate(q.names)])
