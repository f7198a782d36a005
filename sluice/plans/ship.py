"""Makes this package importable in Python workers, wherever the session runs."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors as a zip, once per application (the usual addPyFile)."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    _SHIPPED.add(application)
    package = Path(__file__).resolve().parents[1]
    with tempfile.TemporaryDirectory() as stage:
        shutil.copytree(package, f"{stage}/src/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        keep = Path(tempfile.mkdtemp(prefix="sluice-ship-"))
        spark.sparkContext.addPyFile(shutil.make_archive(str(keep / package.name), "zip", f"{stage}/src"))
