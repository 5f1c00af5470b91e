"""Make this package importable in the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def shipped(spark: SparkSession) -> None:
    """Send the package to the executors, once for each context, as Spark sends any file that it serves."""
    sc = spark.sparkContext
    if getattr(sc, "_petrel_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "petrel_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("petrel", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._petrel_shipped = True
