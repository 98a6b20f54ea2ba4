"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in ``order``.

    Catalyst keeps one row per key and input partition before the shuffle (WindowGroupLimit),
    so a key with very many copies does not reach one task whole.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")
