"""Replacing partitions of a Parquet table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.operators.scratch import file_system

LISTINGS = 16  # folders that are listed at a time
WRITERS = 8  # partitions that a task writes side by side; rows of further ones are sorted first
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything but markers. A table that cannot be read still exists."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return False
    return any(_visible(f.getPath().getName()) for f in fs.listStatus(where))


def _visible(name: str) -> bool:
    """Whether readers see a file or folder; a partition's folder may begin with an underscore."""
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def by_partition(df: DataFrame, column: str, *sort: str) -> DataFrame:
    """Rows gathered per partition value, so a write makes few files.

    Rebalancing lets AQE cut a large value into several tasks and join small ones, which a
    plain ``repartition`` by the column would not.
    """
    return df.hint("rebalance", column).sortWithinPartitions(column, *sort)


def replace_partitions(
    df: DataFrame, path: str, column: str, values: Sequence, *sort: str, split: tuple[str, Sequence[str]] | None = None,
) -> None:
    """Make ``df`` the whole content of the given partitions; other partitions stay.

    Dynamic overwrite keeps the old files until the job has succeeded, but leaves a partition
    alone when no row falls in it. Which ones those are shows in the folders afterwards: a folder
    whose files all are older than the job is replaced by an empty file. So ``df`` runs once, and
    no job runs for an empty partition that was not there. Running again gives the same table.
    ``sort`` orders rows inside each file; without it no task holds its rows to sort them by partition, but
    has a file open for each of its few partitions. ``split`` names a second partition column and all its values,
    by which one write deals rows to the parts of a partition.
    """
    spark, values = df.sparkSession, sorted(set(values))
    columns = [column, split[0]] if split else [column]
    folders = ["/".join(f"{c}={v}" for c, v in zip(columns, pair)) for pair in product(values, *([split[1]] if split else []))]
    rows = df.where(F.col(column).isin(values))
    before = _files(spark, path, folders)
    dealt = rows.hint("rebalance", *columns)
    with _side_by_side(spark, 0 if sort else WRITERS):
        ((dealt.sortWithinPartitions(*columns, *sort) if sort else dealt).write.partitionBy(*columns).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(path))
    after = _files(spark, path, folders)
    stale = [f for f in folders if before[f] and after[f] == before[f]]
    nothing = df.drop(*columns).limit(0)
    if not any(after.values()) and folders:  # a table without a row keeps its columns
        stale = folders[:1]
    for folder in stale:
        nothing.write.mode("overwrite").parquet(f"{path}/{folder}")


@contextmanager
def _side_by_side(spark: SparkSession, writers: int) -> Iterator[None]:
    """Writes in the block have so many files open in a task at a time, or more if the session has more."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, max(writers, int(before)))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def _files(spark: SparkSession, path: str, folders: Sequence[str]) -> dict[str, frozenset[str]]:
    """Names of the data files of each partition; writers never use a name twice."""
    def names(folder: str) -> frozenset[str]:
        fs, where = file_system(spark, f"{path}/{folder}")
        found = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
        return frozenset(filter(_visible, found))

    with ThreadPoolExecutor(LISTINGS) as pool:
        return dict(zip(folders, pool.map(names, folders)))


def partition_rows(stored: DataFrame, column: str, values: Sequence[dt.date]) -> dict[str, int]:
    """Rows per partition of a table as it is stored, so task retries cannot distort them."""
    counts = {str(r[0]): r[1] for r in stored.where(F.col(column).isin(list(values))).groupBy(column).count().collect()}
    return {str(v): counts.get(str(v), 0) for v in values}
