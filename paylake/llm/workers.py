"""Make this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import paylake

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(paylake.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="paylake-"), "paylake_sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
