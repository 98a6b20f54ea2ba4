"""Index of a Parquet table by key: under which day a key is stored.

The index lies beside the table, one row per key and day, in hash buckets. A merge reads only the
buckets of its keys, and learns which days it has to rewrite, instead of the key column of the whole
table. An entry may be out of date, which costs one more day to rewrite; a key that is stored has its
entry always, because entries are added before the table is written and taken away after.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.operators.partitions import replace_partitions
from paylake.operators.scratch import file_system

PER_BUCKET = 1_000_000  # keys; an index with four times as many in its buckets is dealt anew
MOST_BUCKETS = 16_384


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Complete indexes of a table by their number of buckets."""
    fs, where = file_system(spark, path)
    parent, prefix = where.getParent(), f"{where.getName()}_keys-"
    if not fs.exists(parent):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(parent)]
    found = [(int(n.removeprefix(prefix)), f"{path}_keys-{n.removeprefix(prefix)}") for n in names if n.startswith(prefix)]
    return sorted((n, p) for n, p in found if fs.exists(file_system(spark, f"{p}/_SUCCESS")[1]))


class KeyIndex:
    """Index of the table at ``path`` whose rows have a ``key`` and are stored by ``day``."""

    def __init__(self, spark: SparkSession, path: str, key: str, day: str, per_bucket: int = PER_BUCKET):
        self.spark, self.path, self.key, self.day, self.per_bucket = spark, path, key, day, per_bucket
        found = _folders(spark, path)
        self.buckets, self.folder = found[-1] if found else (0, "")

    def build(self, rows: DataFrame, count: int) -> None:
        """Write the whole index for a table with these rows, and drop an older one."""
        old = [p for _, p in _folders(self.spark, self.path)]
        self.buckets = min(MOST_BUCKETS, 2 ** max(0, math.ceil(math.log2(max(1, count) / self.per_bucket))))
        self.folder = f"{self.path}_keys-{self.buckets}"
        self._placed(rows).hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite") \
            .partitionBy("bucket").parquet(self.folder)
        for p in old:
            if p != self.folder:
                fs, where = file_system(self.spark, p)
                fs.delete(where, True)

    def ensure(self) -> None:
        """Build the index from the table where there is none, or where its buckets have become too large."""
        if self.buckets and (self.buckets == MOST_BUCKETS or self._read().count() <= 4 * self.per_bucket * self.buckets):
            return
        table = self.spark.read.parquet(self.path)
        self.build(table.select(self.key, self.day), table.count())

    def _read(self) -> DataFrame:
        kinds = dict(self.spark.read.parquet(self.path).dtypes)
        return self.spark.read.schema(f"{self.key} {kinds[self.key]}, {self.day} {kinds[self.day]}, bucket int").parquet(self.folder)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.key, self.day).distinct().withColumn("bucket", _bucket(self.key, self.buckets))

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets of the keys; at most as many as there are buckets."""
        return sorted(r[0] for r in changes.select(_bucket(self.key, self.buckets).alias("b")).distinct().collect())

    def entries(self, buckets: list[int]) -> DataFrame:
        """key and day of what these buckets hold; other buckets' files are not read."""
        return self._read().where(F.col("bucket").isin(buckets)).drop("bucket")

    def replace(self, rows: DataFrame, buckets: list[int]) -> None:
        """Make the rows the whole content of the buckets."""
        replace_partitions(self._placed(rows), self.folder, "bucket", buckets, self.key)
