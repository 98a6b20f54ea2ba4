"""Connected components of a link table, by alternating star contractions on DataFrames.

Every round hangs each node's larger neighbours, then its smaller ones, on the smallest node
known around it. Rounds grow with the logarithm of the number of nodes. Between rounds the links
lie in a table in the shared folder, so a lost executor repeats one round at most. A node with
very many links is only a grouping key with a running minimum, whose partial results combine
before the shuffle, and a join key, whose partitions Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paylake.operators.scratch import stored


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One contraction of links (a, b) with a > b."""
    if larger:
        around = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links
    least = around.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
    hung = around.join(least, F.col("a") == F.col("node"))
    if larger:
        moved = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).union(hung.select("a", F.col("least").alias("b")))
    moved = moved.where(F.col("a") > F.col("b"))
    return moved if larger else moved.distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        links.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for nodes of links (a, b).

    Links have no direction; null ends, links of a node with itself and repeated links change
    nothing. Nodes that are the smallest of their component are not listed, so an empty table
    gives an empty one.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = stored(links.where("a is not null and b is not null and a <> b").select(*pair).distinct(), "links")
    while True:
        now = stored(_star(_star(now, larger=True), larger=False), "links")
        if _settled(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
