"""Making this package importable in Python workers that don't have it on their path."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_FLAG = "_chronoflow_shipped"


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, _FLAG, False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, path = tempfile.mkstemp(prefix="chronoflow-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(package)))
    context.addPyFile(path)  # executors fetch it from the driver while the driver lives
    atexit.register(lambda: os.path.exists(path) and os.unlink(path))
    setattr(context, _FLAG, True)
