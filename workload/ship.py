"""Sends this code to the Python workers, wherever the session was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PACKAGES = ("commitpost", "workload")
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), "commitpost-code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for package in PACKAGES:
            for folder, _, files in os.walk(os.path.join(ROOT, package)):
                for name in sorted(files):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, ROOT))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
