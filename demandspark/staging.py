"""Written intermediates: cut lineage, survive executor loss, give the planner true sizes.

A table written under the cluster's shared checkpoint folder and read back has file
sizes the planner knows. A small one (scaling parameters, country floors, quantile
buckets) is therefore broadcast, and one that outgrew
``spark.sql.autoBroadcastJoinThreshold`` goes through a sort-merge join that adaptive
execution can split on skew. No broadcast hint is needed, and the large side of the
join is never shuffled for the sake of a small one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_runs: list[str] = []  # folders of the open ``staging`` blocks


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by the session, or a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    if named:
        return "/".join([named.rstrip("/"), "demandspark", app, *_runs])
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="demandspark-")
    return "/".join([_local_roots[app], *_runs])


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the staging root; nothing is created yet."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staging(spark: SparkSession) -> None:
    """Delete what this application (or the open ``staging`` block) has staged; unwritten results are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[SparkSession]:
    """``with staging(spark): ...`` - tables staged inside are deleted at the end. Write results inside."""
    _runs.append(f"run-{uuid.uuid4().hex}")
    try:
        yield spark
    finally:
        clear_staging(spark)
        _runs.pop()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Fix the partition count before rows are multiplied.

    Adaptive execution sizes partitions by their input bytes, so a few compact rows
    about to be exploded would land in one task. An explicit count is not coalesced.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
