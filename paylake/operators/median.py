"""Exact median per group.

The built-in ``percentile`` holds every distinct value of a group in one buffer. That is right for
groups of at most BOUND rows, whatever the size of the table. Larger ones go through a digit-by-digit
selection, in which no task sees more than 200,000 counters of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.operators.scratch import stored
from paylake.operators.skew import same_key

BOUND = 200_000  # rows of a group that may meet in one buffer
_DIGITS = 10**5  # counters per step
_STEPS = 3  # 15 digits of a decimal(15,2)


def _as_number(median: Column) -> Column:
    """Half-way points of two-decimal amounts have three decimals, so nothing is lost."""
    return median.cast("decimal(18,3)").cast("double")


def median_by(df: DataFrame, keys: list[str], amount: str, name: str, sizes: DataFrame, bound: int = BOUND) -> DataFrame:
    """One row per group with the median of ``amount``, a decimal(15,2) column.

    ``sizes``: a stored table with the keys and the number of rows, ``rows``, of every group. There
    may be many large groups, so they are joined, not broadcast by force; AQE splits the large ones.
    """
    large = sizes.where(F.col("rows") > bound).select(*keys)
    if large.isEmpty():
        return _whole(df, keys, amount, name)
    marked = large.select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_large"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    flagged = df.join(marked, same, "left").drop(*[f"_{k}" for k in keys])
    small = _whole(flagged.where("_large is null"), keys, amount, name)
    return small.unionByName(_selected(flagged.where("_large"), keys, amount, name))


def _whole(df: DataFrame, keys: list[str], amount: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(_as_number(F.percentile(F.col(amount), 0.5)).alias(name))


def _selected(df: DataFrame, keys: list[str], amount: str, name: str) -> DataFrame:
    paisa = (F.col(amount) * 100).cast("bigint")
    counts = stored(
        df.where(F.col(amount).isNotNull()).groupBy(*keys, paisa.alias("_v")).agg(F.count("*").alias("_n"))
        .withColumn("_group", same_key(*keys)),
        "value-counts",
    )
    groups = counts.groupBy("_group").agg(*[F.first(k).alias(k) for k in keys], F.sum("_n").alias("_rows"))
    # The two middle rows (the same one for odd counts), numbered from zero.
    targets = groups.select(
        "_group", F.explode(F.array(F.floor((F.col("_rows") - 1) / 2), F.floor(F.col("_rows") / 2))).alias("_rank"),
    ).select("_group", F.col("_rank").alias("_want"), F.col("_rank").cast("bigint").alias("_left")).distinct()

    for step in reversed(range(_STEPS)):
        unit = _DIGITS**step
        parent, bucket = F.expr(f"_v div {unit * _DIGITS}"), F.expr(f"_v div {unit}")
        per_bucket = counts.groupBy("_group", parent.alias("_parent"), bucket.alias("_bucket")).agg(F.sum("_n").alias("_n"))
        on = ["_group"] if step == _STEPS - 1 else ["_group", "_parent"]
        reached = Window.partitionBy("_group", "_want").orderBy("_bucket")
        targets = (
            targets.join(per_bucket, on)
            .withColumn("_upto", F.sum("_n").over(reached.rowsBetween(Window.unboundedPreceding, 0)))
            .where((F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_n")))
            .select("_group", "_want", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"),
                    F.col("_bucket").alias("_parent"))
        )
    middle = targets.groupBy("_group").agg(
        ((F.min("_parent") + F.max("_parent")).cast("decimal(20,0)") / F.lit(200)).alias("_median"))
    return groups.join(middle, "_group").select(*keys, _as_number(F.col("_median")).alias(name))
