"""Page directory: rows in a stored order with counts, so that any page is a seek.

The rows are range-partitioned and sorted once and written by range, each with its place in its
range. The directory has a row per range: where it begins among all rows and how many it has. A page
reads the one or few ranges it lies in; nothing that lies before it is read, sorted or gathered.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paylake.functions.calendar import ntz
from paylake.operators.scratch import new_path

MOST = 500  # rows of a page


@dataclass(frozen=True)
class PageDirectory:
    """Rows in ``order`` under ``path``; ``ranges`` has the number, beginning and size of each range."""

    spark: SparkSession
    path: str
    order: tuple[str, ...]

    @classmethod
    def build(cls, rows: DataFrame, order: Sequence[str], path: str | None = None) -> "PageDirectory":
        """Sort and write the rows. The order has to tell rows apart for pages to be the same in every build."""
        spark = rows.sparkSession
        path = path or new_path(spark, "pages")
        placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
            {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
        placed.write.partitionBy("_range").parquet(f"{path}/rows")
        stored = spark.read.parquet(f"{path}/rows")
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one small row for each range
        sizes = stored.groupBy("_range").agg(F.count("*").alias("n"))
        sizes.select("_range", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")).coalesce(1).write.parquet(f"{path}/ranges")
        return cls(spark, path, tuple(order))

    @property
    def ranges(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/ranges")

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def page(self, offset: int, limit: int = 200) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in order; a page has 1 to MOST rows."""
        _check(limit)
        met = self.ranges.where((F.col("begin") < offset + limit) & (F.col("begin") + F.col("n") > offset)).orderBy("_range").collect()  # few
        if not met:
            return self._rows().limit(0).drop("_range", "_place")
        at: Column = F.lit(None).cast("bigint")
        for r in met:
            at = F.when(F.col("_range") == r["_range"], F.col("_place") + r["begin"]).otherwise(at)
        rows = self._rows().where(F.col("_range").isin([r["_range"] for r in met])).withColumn("_at", at)
        return rows.where((F.col("_at") >= offset) & (F.col("_at") < offset + limit)).orderBy("_at").drop("_range", "_place", "_at")


def _check(limit: int) -> None:
    if not 1 <= limit <= MOST:
        raise ValueError(f"limit must be 1 to {MOST}")


def page_after(rows: DataFrame, order: Sequence[str], last: tuple, limit: int = 200) -> DataFrame:
    """The page that follows the row whose ``order`` columns are ``last``, however deep it lies.

    Only ``limit`` rows meet in a task. The columns must not be null and tell rows apart.
    """
    _check(limit)
    values = [(ntz(v) if isinstance(v, dt.datetime) else F.lit(v)).alias(c) for c, v in zip(order, last)]
    later = F.struct(*order) > F.struct(*values)
    return rows.where(later).orderBy(*order).limit(limit)
