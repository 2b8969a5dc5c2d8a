"""Helpers shared by the text operators: row identity, per-text Arrow stages, row removal."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandspark.shipping import ship_package
from demandspark.staging import staged

# Text handed to Python code at once; a longer text comes alone.
SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
# Columns that name a stored row: hash of its file's path, and its place in that file.
ROW = ["_rf", "_ri"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias"}


def _scans_rows(df: DataFrame) -> bool:
    """Whether the rows of ``df`` are stored rows, each at most once: projections and filters over one relation."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in _ROW_BY_ROW:
        plan = plan.children().head()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def stored(df: DataFrame) -> DataFrame:
    """``df`` if it is a plain Parquet scan, else a staged copy of it, so that ``keyed`` names its rows.

    A row of a join, a union or an explode has no place of its own, and one of a JSON file
    or of memory none that is known. A function that calls ``keyed`` more than once calls
    this first: each staged copy has places of its own.
    """
    if _scans_rows(df):
        try:
            _with_identity(df)
            return df
        except AnalysisException:
            pass
    return staged(df, "stored")


def keyed(df: DataFrame) -> DataFrame:
    """``rec`` (the whole row as a struct) with the row's identity in ``_rf`` and ``_ri``.

    A stored row keeps its identity in every scan, however the files are split, so
    decisions made on slim rows find their way back also where ids are null or repeat.
    """
    return _with_identity(stored(df))


def _with_identity(df: DataFrame) -> DataFrame:
    meta = df.metadataColumn("_metadata")
    keys = F.xxhash64(meta["file_path"]).alias(ROW[0]), meta["row_index"].alias(ROW[1])
    out = df.select(F.struct("*").alias("rec"), *keys)
    return out


def without(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``df`` less the rows that ``rows`` names by ``_rf`` and ``_ri``; same columns.

    The planner broadcasts ``rows`` only below its size threshold and sort-merges beyond.
    """
    return keyed(df).join(rows.select(*ROW), ROW, "left_anti").select("rec.*")


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def arrow_stage(df: DataFrame, run: Run, schema) -> DataFrame:
    """``df.mapInArrow`` by a function of this package, wherever the workers run.

    Rows with whole texts are large: the session's Arrow batches are brought down to
    BATCH_ROWS, which bounds the buffers on both sides of the pipe, and a worker gives
    back what its Arrow pool holds when a task ends.
    """
    spark = df.sparkSession
    ship_package(spark)
    if int(spark.conf.get(_BATCH_CONF, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(whole, schema)


def text_function(
    fields: T.StructType, text: str, out: str, make: Callable[[], Callable[[list], dict]]
) -> tuple[Run, T.StructType]:
    """A function for ``arrow_stage`` and its schema: ``fields`` without ``text``, then ``out``.

    A column of ``out`` replaces one of the same name.

    ``make()`` runs once in each task and gives a function from a list of texts (None for
    null) to equally long columns by name.
    """
    added = T._parse_datatype_string(out)
    kept = [f for f in fields.fields if f.name != text and f.name not in added.names]
    schema = T.StructType(kept + added.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401 - makes pa.compute known in the worker

        work = make()
        for batch in batches:
            for part in _slices(batch, text):
                columns = work(part.column(text).to_pylist())
                arrays = [part.column(f.name) for f in kept]
                arrays += [
                    x if isinstance(x, pa.Array) else pa.array(x, type=arrow.field(f.name).type)
                    for f, x in ((f, columns[f.name]) for f in added.fields)
                ]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(t) if a.type != t else a for a, t in zip(arrays, arrow.types)], schema=arrow
                )

    return run, schema


def text_stage(df: DataFrame, text: str, out: str, make: Callable[[], Callable[[list], dict]]) -> DataFrame:
    """One narrow Arrow stage by ``text_function``."""
    return arrow_stage(df, *text_function(df.schema, text, out, make))


class Cache(dict):
    """Results of ``make`` by key, in two generations of at most ``entries`` each.

    When the young one is full it becomes the old one; what is asked for again moves back.
    Keys longer than ``longest`` are made anew each time.
    """

    def __init__(self, make: Callable, entries: int, longest: int):
        self._make, self._entries, self._longest, self._old = make, entries, longest, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= self._longest:
            if len(self) >= self._entries:
                self._old = dict(self)
                self.clear()
            self[key] = value
        return value


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
