"""Prediction files of an outside scorer: headerless or keyed CSV, aligned by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.columns import strip_quotes, to_number
from demandspark.operators.validate import refuse, require_columns
from demandspark.sources.tables import read_text_columns
from demandspark.spec import Quantiles
from demandspark.staging import staged


def read_predictions(
    spark: SparkSession, path: str, quantiles: Quantiles = Quantiles(), glob: str | None = None
) -> DataFrame:
    """Headerless files with exactly one column per quantile; bad cells become null."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in quantiles.names])
    reader = spark.read.schema(schema).option("header", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _numeric(reader.csv(path), quantiles)


def read_predictions_tail(
    spark: SparkSession, path: str, quantiles: Quantiles = Quantiles(), glob: str | None = None
) -> DataFrame:
    """Headerless files whose last columns are the quantiles; cells may be padded and quoted."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # The last fields of each line, so a file's width plays no part; a quoted field may hold commas.
    field = r'(?:^|,)(\s*"(?:[^"]|"")*"\s*|[^,"]*)'
    pattern = field * len(quantiles.names) + "$"
    lines = reader.text(path).where(F.trim("value") != "")
    cells = {n: F.regexp_extract("value", pattern, i + 1) for i, n in enumerate(quantiles.names)}
    return _numeric(lines.select(*[c.alias(n) for n, c in cells.items()]), quantiles)


def read_keyed_predictions(
    spark: SparkSession, path: str, keys: Sequence[str], quantiles: Quantiles = Quantiles()
) -> DataFrame:
    """Files with a header that carry the series keys beside the quantiles."""
    raw = read_text_columns(spark, path)
    require_columns(raw, [*keys, *quantiles.names])
    return _numeric(raw, quantiles)


def require_predictions(predictions: DataFrame) -> DataFrame:
    """Fail when no prediction row was found."""
    if predictions.isEmpty():
        raise FileNotFoundError("no prediction rows found")
    return predictions


def _numeric(df: DataFrame, quantiles: Quantiles) -> DataFrame:
    return df.withColumns({n: to_number(strip_quotes(F.col(n))) for n in quantiles.names})


def with_file_rows(read: DataFrame) -> DataFrame:
    """Add ``file`` (name without folder and extension) and ``row``, numbered from 0 per file.

    Ids rise along each file split, so a row's number is the rows of the earlier splits
    plus its id less the smallest id of its own split. The tagged rows are staged, which
    fixes the ids: a second scan could cut the files differently. Only one count per
    split is shuffled; the rows stay where they are.
    """
    tagged = staged(
        read.select(
            *read.columns,
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
        ),
        "tagged",
    )
    # One row per split of one file: the window over a file stays small.
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = staged(
        tagged.groupBy("_path", "_block")
        .agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n"),
        "splits",
    )
    # The name up to its first dot: batch.csv and batch.csv.out are the same batch.
    stem = F.split(F.element_at(F.split("_path", "/"), -1), r"\.", 2)[0]
    return (
        tagged.join(splits, ["_path", "_block"])
        .withColumns(
            {
                "file": stem,
                "row": (F.col("_id") - F.col("_first") + F.col("_before")).cast("long"),
            }
        )
        .drop("_path", "_block", "_id", "_first", "_before")
    )


def align_by_position(requests: DataFrame, predictions: DataFrame) -> DataFrame:
    """Join request and prediction rows on (file, row); row counts must agree per file."""
    uneven = (
        requests.groupBy("file").agg(F.count("*").alias("requests"))
        .join(predictions.groupBy("file").agg(F.count("*").alias("predictions")), "file", "full")
        .where(~F.col("requests").eqNullSafe(F.col("predictions")))
    )
    refuse(uneven, "request and prediction files differ in length")
    return requests.join(predictions, ["file", "row"]).drop("file", "row")
