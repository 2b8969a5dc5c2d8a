"""Exact linear-interpolation quantiles of groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one task. That is fine
for a series at daily grain (bounded by the calendar) but not for a currency, a branch
or a whole table. For such hot groups ``exact_quantiles`` narrows the wanted order
statistics instead:

1. count values per (group, coarse bucket), where the bucket is a monotone function of
   the value - combined map-side, so only counts are shuffled;
2. running counts over those buckets name the bucket that holds each wanted rank;
3. only rows of the named buckets are read again, cut into finer buckets, and narrowed
   once more; the few remaining values are ranked exactly.

The bucket lists are tiny and staged, so the data is filtered by a broadcast join and
never shuffled whole, and no task sees more than a sliver of a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.staging import staged

_COARSE_PER_LOG_UNIT = 256
_FINE_BUCKETS = 1024
_NEVER_NULL = ("_all", "_b1", "_b2")


def _coarse_bucket(x: Column) -> Column:
    """Monotone in x, about 256 buckets for each factor of e: at most some 360,000 in all."""
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * _COARSE_PER_LOG_UNIT).cast("long")


def _fine_bucket(x: Column, low: Column, high: Column) -> Column:
    # Halved before subtracting, so the span of two huge values of opposite sign stays finite.
    span = high / 2 - low / 2
    share = F.when(span > 0, (x / 2 - low / 2) / span).otherwise(F.lit(0.0))
    return F.floor(share * _FINE_BUCKETS).cast("long")


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality on all columns, null-safe for keys; our own bucket columns are never null."""
    def equal(c: str) -> Column:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        return a == b if c in _NEVER_NULL else a.eqNullSafe(b)

    return reduce(lambda a, b: a & b, map(equal, columns))


def _buckets_with_ranks(counts: DataFrame, parts: list[str], bucket: str) -> DataFrame:
    """Buckets that hold a wanted rank, with those ranks relative to the bucket start."""
    running = Window.partitionBy(*parts).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(running), F.lit(0)).cast("long")
    return (
        counts.withColumn("_start", start)
        .withColumn(
            "_ranks",
            F.filter("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_n"))),
        )
        .where(F.size("_ranks") > 0)
        .withColumn("_ranks", F.transform("_ranks", lambda r: r - F.col("_start")))
        .withColumn("_offset", F.col("_offset") + F.col("_start"))
        .drop("_start")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
) -> DataFrame:
    """One row per group with the named quantiles of the non-null values.

    Every group is narrowed, whatever its size. ``df`` is scanned three times, so pass a
    table or a ``staged`` frame if it is expensive to derive.
    """
    keys = list(keys)
    parts = keys or ["_all"]
    wanted = dict(zip(names, [float(p) for p in probabilities]))
    values = df.select(
        *keys, F.lit(0).alias("_all"), F.col(value).cast("double").alias("_x")
    ).where(F.col("_x").isNotNull() & ~F.isnan("_x"))

    return _narrowed(values, parts, wanted).select(*keys, *names)


def _narrowed(values: DataFrame, parts: list[str], wanted: dict[str, float]) -> DataFrame:
    coarse = (
        values.withColumn("_b1", _coarse_bucket(F.col("_x")))
        .groupBy(*parts, "_b1")
        .agg(F.count("*").alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    )
    group = Window.partitionBy(*parts)
    positions = [F.lit(p) * (F.col("_total") - 1) for p in wanted.values()]
    ranks = F.array_distinct(
        F.array(*[f(x).cast("long") for x in positions for f in (F.floor, F.ceil)])
    )
    first = staged(
        _buckets_with_ranks(
            coarse.withColumn("_total", F.sum("_n").over(group).cast("long"))
            .withColumn("_ranks", ranks)
            .withColumn("_offset", F.lit(0).cast("long")),
            parts,
            "_b1",
        ),
        "quantile-coarse",
    )

    columns = [*parts, "_b1"]
    chosen = values.withColumn("_b1", _coarse_bucket(F.col("_x"))).alias("v").join(
        first.select(*columns, "_low", "_high").alias("b"), _same("v", "b", columns)
    )
    fine = (
        chosen.select(
            *[F.col(f"v.{c}").alias(c) for c in columns],
            "_x",
            _fine_bucket(F.col("_x"), F.col("_low"), F.col("_high")).alias("_b2"),
        )
        .groupBy(*columns, "_b2")
        .agg(F.count("*").alias("_n"), F.min("_x").alias("_low2"), F.max("_x").alias("_high2"))
        .alias("f")
        .join(first.drop("_n", "_low", "_high").alias("b"), _same("f", "b", columns))
        .select(
            *[F.col(f"f.{c}").alias(c) for c in columns],
            "_b2", "_n", "_low2", "_high2", "_total", "_ranks", "_offset",
        )
    )
    columns2 = [*columns, "_b2"]
    second = staged(_buckets_with_ranks(fine, columns, "_b2"), "quantile-fine")

    # A bucket of one repeated value is settled by its bounds; only the others are read again.
    settled = second.where("_low2 = _high2").select(
        *parts, "_total", F.explode("_ranks").alias("_r"), "_offset", F.col("_low2").alias("_x")
    )
    open_buckets = second.where("_low2 < _high2")
    exact = (
        values.withColumn("_b1", _coarse_bucket(F.col("_x"))).alias("v")
        .join(first.select(*columns, "_low", "_high").alias("b"), _same("v", "b", columns))
        .select(
            *[F.col(f"v.{c}").alias(c) for c in columns],
            "_x",
            _fine_bucket(F.col("_x"), F.col("_low"), F.col("_high")).alias("_b2"),
        )
        .alias("v")
        .join(open_buckets.select(*columns2).alias("o"), _same("v", "o", columns2), "left_semi")
        .groupBy(*columns2, "_x")
        .agg(F.count("*").alias("_n"))
    )
    ranked = _buckets_with_ranks(
        exact.alias("e")
        .join(open_buckets.drop("_n").alias("o"), _same("e", "o", columns2))
        .select(*[F.col(f"e.{c}").alias(c) for c in columns2], "_x", "_n", "_total", "_ranks", "_offset"),
        columns2,
        "_x",
    ).select(*parts, "_total", F.explode("_ranks").alias("_r"), "_offset", "_x")

    statistics = settled.unionByName(ranked).withColumn("_rank", F.col("_r") + F.col("_offset"))
    by_rank = statistics.groupBy(*parts, "_total").agg(
        F.map_from_entries(F.collect_set(F.struct("_rank", "_x"))).alias("_at")
    )
    result = []
    for name, position in zip(wanted, positions):
        below = F.col("_at")[F.floor(position).cast("long")]
        above = F.col("_at")[F.ceil(position).cast("long")]
        result.append((below + (above - below) * (position - F.floor(position))).alias(name))
    return by_rank.select(*parts, *result)
