"""Make this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's sources to the executors of this application, once.

    Functions that Spark runs in Python workers are found there by module name. The archive
    is written beside the driver only; Spark's own file server distributes it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="demandspark-"), "demandspark_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
