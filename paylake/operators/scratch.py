"""Tables written between jobs, in the folder the cluster shares for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for local masters."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="paylake-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object; Spark has no call of its own to delete a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under one folder per application, deleted when the application ends."""
    folder = f"{shared_dir(spark)}/paylake-{spark.sparkContext.applicationId}"
    fs, where = file_system(spark, folder)
    if fs.mkdirs(where):
        fs.deleteOnExit(where)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: cuts lineage and, unlike a checkpoint, keeps column pruning."""
    return _write(df, new_path(df.sparkSession, name))


@contextmanager
def stored_for(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stored`` for the length of a block; nothing that reads it may outlive the block."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        yield _write(df, path)
    finally:
        fs, where = file_system(spark, path)
        fs.delete(where, True)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
