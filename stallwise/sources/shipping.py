"""The package sent to Python workers, wherever the session was started."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add this package to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='stallwise-')}/stallwise", "zip", root, "stallwise")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
