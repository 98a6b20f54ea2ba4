"""Merge of new rows into a Parquet table partitioned by day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from paylake.operators.key_index import PER_BUCKET, KeyIndex
from paylake.operators.partitions import by_partition, replace_partitions, table_exists
from paylake.operators.scratch import stored_for


class DuplicateKey(ValueError):
    """A merge was given more than one row for a key."""


def merged(existing: DataFrame, changes: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``existing`` without the keys ``gone``, and ``changes``."""
    return existing.join(gone, key, "left_anti").select(existing.columns).unionByName(changes)


def upsert(
    changes: DataFrame, path: str, key: str, day: str, per_bucket: int = PER_BUCKET, note: Callable[[list], None] = lambda days: None,
    removed: DataFrame | None = None,
) -> list:
    """Merge into the table at ``path``, rewriting only the days that change, and return these.

    They are the days of the new rows and the days the replaced rows are stored under, since a row
    may move; an index by key beside the table knows the latter. ``removed`` has keys whose rows go.
    ``note`` is told the days before any of them is written. Several rows of one key raise
    ``DuplicateKey`` before anything is written. A merge that was stopped anywhere is repaired by
    running it again: the index may know too many days of a key, never too few.
    """
    spark = changes.sparkSession
    with stored_for(changes, "changes") as changes:
        again = changes.groupBy(key).count().where("count > 1").first()
        if again:
            raise DuplicateKey(f"{again['count']} rows of {key} {again[0]!r}")
        index, new = KeyIndex(spark, path, key, day, per_bucket), changes.select(key, day)
        if not table_exists(spark, path):
            days = sorted(r[0] for r in new.select(day).distinct().collect())
            note(days)
            index.build(changes, changes.count())
            by_partition(changes, day).write.partitionBy(day).mode("errorifexists").parquet(path)
            return days
        index.ensure()
        gone = new.select(key) if removed is None else new.select(key).union(removed.select(key)).distinct()
        buckets = index.touched(gone)
        with stored_for(index.entries(buckets), "entries") as known:
            stored_under = known.join(gone, key, "left_semi")
            days = sorted(r[0] for r in new.select(day).union(stored_under.select(day)).distinct().collect())
            note(days)
            index.replace(known.select(key, day).union(new), buckets)
            table = spark.read.parquet(path)
            rows = merged(table.where(F.col(day).isin(days)), changes, key, gone).select(table.columns)
            with stored_for(rows, "merged") as rows:
                replace_partitions(rows, path, day, days)
            moved = stored_under.join(new, [key, day], "left_anti")
            if not moved.isEmpty():  # entries of rows that have left their day
                index.replace(known.join(gone, key, "left_anti").select(key, day).union(new), buckets)
    return days
