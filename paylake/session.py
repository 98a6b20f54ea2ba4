"""Session for local runs and tests; on a cluster the submitter brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "paylake", cpus: str | int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PAYLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
