"""Column profiles of a whole table; groups here are columns, so nothing is grouped in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.columns import strip_thousands
from demandspark.functions.comoments import comoments, correlation
from demandspark.functions.normal_scores import scores
from demandspark.functions.quantiles import exact_quantiles
from demandspark.shipping import ship_package
from demandspark.staging import staged

# Histogram bins, whisker length, text of a failed prediction.
BINS = 20
WHISKER = 1.5
SENTINEL = "ERROR"
_RUN = 1 << 16  # ranks of one value that are scored at once


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows with value as double; nulls and NaN left out."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot([], list(columns), "column", "value")
    return long.where("value is not null and not isnan(value)")


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Per column: type, rows, non-null, null and distinct counts.

    Each column is counted on its own: a columnar source reads every column once, and
    only that column's values are shuffled. Counting all distinct values in one aggregate
    would shuffle each row once per column, at the width of all columns.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    types = dict(df.dtypes)

    def profile(c: str) -> DataFrame:
        return df.agg(
            F.count(c).alias("n_present"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            distinct(F.col(c)).alias("n_distinct"),
            F.count("*").alias("n_rows"),
        ).select(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), "*")

    return reduce(DataFrame.unionByName, [profile(c) for c in columns or df.columns])


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation, one row per ordered pair, from one scan.

    Null where a column is constant or all null; NaN counts as null. No aggregate grows
    with the number of pairs: see ``comoments``.
    """
    columns = list(columns or numeric_columns(df))
    # One name for each column: as many as the schema has.
    names = F.array(*map(F.lit, columns))
    every = df.sparkSession.range(len(columns) ** 2).select(
        (F.col("id") % len(columns)).cast("int").alias("i"), F.floor(F.col("id") / len(columns)).cast("int").alias("j")
    )
    moments = comoments(df, columns)
    found = moments.select("i", "j", correlation(moments).alias("corr"))
    return every.join(
        found.withColumnsRenamed({"i": "a", "j": "b"}),
        (F.least("i", "j") == F.col("a")) & (F.greatest("i", "j") == F.col("b")), "left",
    ).select(F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"), "corr")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Equal-width counts per column, the last bin closed; empty bins have no row."""
    long = melt(df, columns)
    # One row per column: its size is that of the schema, whatever the data.
    ranges = F.broadcast(
        long.groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )
    width = (F.col("high") - F.col("low")) / bins
    position = F.try_divide(F.col("value") - F.col("low"), F.col("high") - F.col("low")) * bins
    bin_no = F.least(F.floor(F.coalesce(position, F.lit(0.0))).cast("int"), F.lit(bins - 1))
    return (
        long.join(ranges, "column")
        .groupBy("column", bin_no.alias("bin"), F.col("low"), width.alias("_width"))
        .agg(F.count("*").alias("n"))
        .select(
            "column",
            "bin",
            (F.col("low") + F.col("bin") * F.col("_width")).alias("left"),
            (F.col("low") + (F.col("bin") + 1) * F.col("_width")).alias("right"),
            "n",
        )
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and values beyond, per column."""
    long = melt(df, columns)
    quartiles = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        # One row per column: its size is that of the schema, whatever the data.
        long.join(F.broadcast(quartiles), "column")
        .groupBy("column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_fliers"),
            F.count("*").alias("n"),
        )
    )


def jarque_bera(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Normality screen from skewness and excess kurtosis, with its chi-square(2) p-value."""
    moments = melt(df, columns).groupBy("column").agg(
        F.count("value").alias("n"),
        F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("excess_kurtosis"),
    )
    s, k = F.col("skewness"), F.col("excess_kurtosis")
    return moments.withColumn(
        "jarque_bera", F.col("n") / 6.0 * (s * s + k * k / 4.0)
    ).withColumn("p_value", F.exp(-F.col("jarque_bera") / 2.0))


def shapiro_francia(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column``, ``n``, ``w`` and ``z``: squared correlation of the ordered values with normal scores.

    ``w`` is one for a normal sample; ``z`` is its standardised form (the larger, the less
    normal; meant for 5 to 5,000 values). Ranks are exact and global: equal values combine
    map-side into one row with their count, a range sort deals the distinct values to all
    tasks, and counts of each task's run give the ranks. A value that many rows share is cut
    into runs of ranks, so neither a column nor a value is bound to one task. Constant
    columns have no ``w``; null and NaN are left out.
    """
    ship_package(df.sparkSession)
    values = staged(melt(df, columns).groupBy("column", "value").agg(F.count("*").alias("count")), "distinct-values")
    n_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.repartitionByRange(n_tasks, "column", "value").sortWithinPartitions("column", "value")
    numbered = staged(dealt.withColumn("spot", F.monotonically_increasing_id()), "ordered-values")
    numbered = numbered.withColumn("part", F.shiftright("spot", 33))
    # A column has at most one run in each task, and as many rows here as tasks.
    runs = numbered.groupBy("column", "part").agg(
        F.sum("count").alias("size"), F.sum(F.col("value") * F.col("count")).alias("total")
    )
    of_column = Window.partitionBy("column")
    runs = staged(runs.select(
        "column", "part", (F.sum("size").over(of_column.orderBy("part")) - F.col("size")).alias("before"),
        F.sum("size").over(of_column).alias("n"), (F.sum("total").over(of_column) / F.sum("size").over(of_column)).alias("mean"),
    ), "value-runs")
    within = F.sum("count").over(Window.partitionBy("column", "part").orderBy("spot")) - F.col("count")
    ranked = numbered.withColumn("within", within).join(runs, ["column", "part"])
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(_RUN).cast("long"))).alias("from")
    ranked = ranked.select("column", "n", (F.col("value") - F.col("mean")).alias("off"), "count", (F.col("before") + F.col("within")).alias("rank"), run)
    ranked = ranked.select("column", "n", "off", (F.col("rank") + F.col("from")).alias("rank"), F.least(F.col("count") - F.col("from"), F.lit(_RUN)).alias("count"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, off, rank, count = (batch.column(k).to_numpy() for k in ("n", "off", "rank", "count"))
            group = np.cumsum(count) // (4 * _RUN)  # values whose ranks are laid out together
            for some in np.split(np.arange(len(n)), np.flatnonzero(np.diff(group)) + 1):
                if not len(some):
                    continue
                size = count[some]
                m = scores(rank[some], size, n[some])
                first = np.cumsum(size) - size
                yield pa.RecordBatch.from_pydict({
                    "column": batch.column("column").take(pa.array(some)), "n": pa.array(n[some], pa.int64()),
                    "cross": pa.array(off[some] * np.add.reduceat(m, first)),
                    "square": pa.array(np.add.reduceat(m * m, first)), "spread": pa.array(off[some] ** 2 * size),
                })

    parts = ranked.mapInArrow(scored, "column string, n long, cross double, square double, spread double")
    w = F.when(F.sum("spread") > 0, F.pow(F.sum("cross"), 2) / (F.sum("square") * F.sum("spread")))
    found = parts.groupBy("column", "n").agg(w.alias("w"))
    # Royston's normalising approximation.
    v = F.log("n")
    u = F.log(v)
    z = (F.log(1 - F.col("w")) - (-1.2725 + 1.0521 * (u - v))) / (1.0308 - 0.26758 * (u + 2 / v))
    return found.select("column", "n", "w", F.when(F.col("w") < 1, z).alias("z"))


def prediction_sentinels(df: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """Per text column: non-null cells and cells that hold the failure text."""
    wide = df.agg(
        *[
            F.struct(
                F.count(c).alias("n_present"), F.count_if(F.col(c) == sentinel).alias("n_sentinel")
            ).alias(c)
            for c in df.columns
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("s")) for c in df.columns]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.column", "r.s.n_present", "r.s.n_sentinel")


def numeric_text(df: DataFrame, column: str) -> DataFrame:
    """Rows that have the column, its thousands commas removed and the text made a number."""
    return df.where(F.col(column).isNotNull()).withColumn(column, strip_thousands(F.col(column)))


def first_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(n)
