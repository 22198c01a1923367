"""Sends this package to the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let workers import the package, also where it isn't installed: Spark copies an
    archive of it to every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="tagmatch-"), "tagmatch.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    _sent.add(context.applicationId)
