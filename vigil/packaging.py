"""Sends this package to the executors' Python, which need no installed copy."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once a session; the archive is made on the driver's disk, and Spark hands it out."""
    context = spark.sparkContext
    if getattr(context, "_vigil_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(tempfile.mkdtemp(prefix="vigil-ship-"), "vigil_package.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("vigil", os.path.relpath(path, root)))
    context.addPyFile(to)
    context._vigil_shipped = True
