"""Prepare a session: the package for its Python workers, and batches for long texts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Rows are whole documents here; smaller batches bound what a worker holds.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once per application."""
    if spark.conf.get(_BATCH) == "10000":  # Spark's own default
        spark.conf.set(_BATCH, "2048")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="quern-"), "quern_sources.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(top, "quern")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
