"""Sending this package to the Python workers, once an application."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import ``arpent`` wherever they run; the driver hands the files out itself."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="spark-arpent-"), "arpent-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(top.rglob("*.py")):
            z.write(file, f"{top.name}/{file.relative_to(top)}")
    sc.addPyFile(path)
    _sent.add(sc.applicationId)
