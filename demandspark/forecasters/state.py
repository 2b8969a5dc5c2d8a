"""What a forecaster needs of a series, as one mergeable row: new days advance it, old ones are not read again.

A state holds the last rows of a series and its exponentially weighted moments at its last
date. Two states of different rows of a series merge into that of all of them, in any
order and with late rows in either, so a day's new rows become a small state of their own
and are merged into the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.columns import interpolated
from demandspark.spec import DATE, DEMAND, ForecastSpec

ALPHA = 0.3


def state_of(rows: DataFrame, spec: ForecastSpec = ForecastSpec(), alpha: float = ALPHA) -> DataFrame:
    """One row for each series of ``rows`` (daily grain; null demand left out).

    ``last`` is the last date, ``recent`` the last ``trailing_rows`` rows in order, and
    ``weight``, ``mean``, ``moment`` are the sum of weights, the weighted mean and the weighted
    squares about it, where a row's weight falls by ``1 - alpha`` for each day before ``last``.
    One shuffle by series; a series is bounded by the calendar.
    """
    keys = list(spec.keys)
    of_series = Window.partitionBy(*keys)
    known = rows.where(F.col(DEMAND).isNotNull()).select(*keys, DATE, F.col(DEMAND).cast("double").alias(DEMAND))
    weight = F.pow(F.lit(1.0 - alpha), F.datediff("_last", F.col(DATE)))
    placed = known.select(
        *keys, DATE, DEMAND, F.max(DATE).over(of_series).alias("_last"), F.avg(DEMAND).over(of_series).alias("_centre"),
        F.row_number().over(of_series.orderBy(F.col(DATE).desc())).alias("_back"),
    ).withColumns({"_w": weight, "_off": F.col(DEMAND) - F.col("_centre")})
    recent = F.when(F.col("_back") <= spec.trailing_rows, F.struct(DATE, DEMAND))
    w, off = F.col("_w"), F.col("_off")
    found = placed.groupBy(*keys).agg(
        F.max("_last").alias("last"), F.sort_array(F.collect_list(recent)).alias("recent"), F.sum("_w").alias("weight"),
        (F.sum(w * off) / F.sum("_w")).alias("_shift"), F.sum(w * off * off).alias("_squares"), F.first("_centre").alias("_centre"),
    )
    return found.select(
        *keys, "last", "recent", "weight", (F.col("_centre") + F.col("_shift")).alias("mean"),
        F.greatest(F.col("_squares") - F.col("weight") * F.col("_shift") * F.col("_shift"), F.lit(0.0)).alias("moment"),
    )


def merge_states(a: DataFrame, b: DataFrame, spec: ForecastSpec = ForecastSpec(), alpha: float = ALPHA) -> DataFrame:
    """The states of all rows that ``a`` and ``b`` saw; a series of one of them alone stays as it is.

    One join of tables with a row a series.
    """
    keys, fields = list(spec.keys), ["last", "recent", "weight", "mean", "moment"]
    left = a.select(*keys, F.struct(*fields).alias("x"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*fields).alias("y"))
    meets = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = left.join(right, meets, "full").select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], "x", "y")
    last = F.greatest("x.last", "y.last")

    def aged(side: str) -> Column:
        return F.coalesce(F.pow(F.lit(1.0 - alpha), F.datediff(last, F.col(f"{side}.last"))), F.lit(0.0))

    u, v = F.col("x.weight") * aged("x"), F.col("y.weight") * aged("y")
    gap = F.col("y.mean") - F.col("x.mean")
    merged = F.struct(
        last.alias("last"),
        F.slice(F.sort_array(F.concat("x.recent", "y.recent")), F.greatest(
            F.size("x.recent") + F.size("y.recent") - spec.trailing_rows + 1, F.lit(1)), spec.trailing_rows).alias("recent"),
        (u + v).alias("weight"), (F.col("x.mean") + gap * v / (u + v)).alias("mean"),
        (F.col("x.moment") * aged("x") + F.col("y.moment") * aged("y") + gap * gap * u * v / (u + v)).alias("moment"),
    )
    one = F.when(F.col("y").isNull(), F.col("x")).when(F.col("x").isNull(), F.col("y")).otherwise(merged)
    return both.select(*keys, one.alias("s")).select(*keys, *[F.col(f"s.{f}").alias(f) for f in fields])


def advance(state: DataFrame, new_rows: DataFrame, spec: ForecastSpec = ForecastSpec(), alpha: float = ALPHA) -> DataFrame:
    """``state`` after ``new_rows`` (series and days that it has not seen)."""
    return merge_states(state, state_of(new_rows, spec, alpha), spec, alpha)


def forecast_states(state: DataFrame, spec: ForecastSpec = ForecastSpec(), methods: Sequence[str] = ("trailing_quantile", "exp_smoothing")) -> DataFrame:
    """``method``, series, origin (its last date) and quantiles, from the states alone.

    ``trailing_quantile`` takes quantiles of the last rows, ``exp_smoothing`` a normal band about
    the weighted mean: what the forecasters of those names say at a series' last date.
    """
    q = spec.quantiles
    values = F.sort_array(F.transform("recent", lambda r: r[DEMAND]))
    spread = F.sqrt(F.col("moment") / F.col("weight"))
    quantiles = {
        "trailing_quantile": [interpolated(F.col("_ordered"), p).alias(n) for n, p in q.levels],
        "exp_smoothing": [(F.col("mean") + NormalDist().inv_cdf(p) * spread).alias(n) for n, p in q.levels],
    }
    structs = F.array(*[F.struct(F.lit(m).alias("method"), *quantiles[m]) for m in methods])
    rows = state.withColumn("_ordered", values).select(*spec.keys, F.col("last").alias(DATE), F.explode(structs).alias("f"))
    return rows.select("f.method", *spec.keys, DATE, *[F.col(f"f.{n}").alias(n) for n in q.names])
