"""Rows of lowest hash, chosen by counts alone."""

import pytest
from pyspark.sql import functions as F

from paylake.llm.sampling import lowest


@pytest.mark.parametrize("most", [0, 1, 100, 5_000])
def test_bounded_and_lowest(spark, most):
    rows = spark.range(6_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("kind"))
    rows = rows.where("kind is null or kind = 'a' or doc_id < 600")
    chosen = rows.where(lowest(rows, "doc_id", "kind", most)).withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id"), 40))
    left = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id"), 40)).join(chosen.select("doc_id"), "doc_id", "left_anti")
    for kind, n in (("a", 2_000), ("b", 200), (None, 2_000)):
        own = chosen.where(F.col("kind").eqNullSafe(kind))
        got = own.count()
        assert got <= most and got >= min(n, most) - 2
        rest = left.where(F.col("kind").eqNullSafe(kind)).agg(F.min("place")).first()[0]
        if got and rest is not None:
            assert own.agg(F.max("place")).first()[0] < rest


def test_numbers_by_class_and_empty_table(spark):
    rows = spark.range(1_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("kind"))
    got = {r[0]: r[1] for r in rows.where(lowest(rows, "doc_id", "kind", {0: 10, 1: 50})).groupBy("kind").count().collect()}
    assert set(got) == {0, 1} and got[0] <= 10 and 45 <= got[1] <= 50
    assert rows.limit(0).where(lowest(rows.limit(0), "doc_id", "kind", 5)).count() == 0
