"""Make the package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Task functions are pickled by reference, so the workers need ``tastemap`` wherever the
    driver was started: zip the package once per SparkContext and add it with ``addPyFile``
    (Spark serves the file to the executors). On a cluster, ``--py-files`` does the same."""
    sc = spark.sparkContext
    if getattr(sc, "_tastemap_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tastemap-pkg-"), "tastemap.zip")
    with zipfile.ZipFile(path, "w") as z:
        for root, _, files in os.walk(os.path.join(ROOT, "tastemap")):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, ROOT))
    sc.addPyFile(path)
    sc._tastemap_shipped = True
