"""Gives executors this library's code, so that Python functions sent to them can import it, and their tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_spanweave_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="spanweave-")), "spanweave_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as code:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    code.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)
    context._spanweave_shipped = True


def tasks(spark: SparkSession) -> int:
    """Into how many tasks rows are dealt by number that cost far more than their bytes show."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
