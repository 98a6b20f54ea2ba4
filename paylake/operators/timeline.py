"""Per-sender sequence numbers and counts over time.

All five columns come from one hash exchange and one sort: the windows nest (sender, day,
hour), and ordering by (day, hour, time, id) is the same as ordering by (time, id).

A hot sender would put all its rows in one task, so its rows are cut into one-second
slices. Counts per slice combine before their shuffle; running totals over slices within
an hour (3,600 at most) and over hours of a sender (24 a day) give each slice's offset,
which is added to the position inside the slice. A second that is itself too large is cut
further by a range partitioning over (time, id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.config import SkewPolicy
from paylake.functions.calendar import second_number
from paylake.operators.scratch import stored
from paylake.operators.skew import flag_hot, same_key

RANKS = ("sender_lifetime_rank", "sender_daily_rank")
COUNTS = ("sender_hour_txns", "sender_day_txns", "sender_day_failures")
_ORDER = ("txn_date", "txn_hour", "txn_timestamp", "txn_id")
_HOUR = ("_owner", "txn_date", "txn_hour")
_SLICE = ("_owner", "_slice", "_piece")


def _is_failed() -> Column:
    return F.col("status") == "FAILED"


def with_sender_timeline(txns: DataFrame, hot_senders: DataFrame | None = None, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Add lifetime and daily rank of each transaction and its sender's hourly and daily counts."""
    if hot_senders is None:
        return _ranked(txns, ["sender_vpa"])
    return _ranked_in_slices(flag_hot(txns, hot_senders, "_hot"), policy)


def _ranked(txns: DataFrame, owner: list[str]) -> DataFrame:
    life = Window.partitionBy(*owner).orderBy(*_ORDER)
    day = Window.partitionBy(*owner, "txn_date").orderBy(*_ORDER[1:])
    whole_day = Window.partitionBy(*owner, "txn_date")
    whole_hour = Window.partitionBy(*owner, "txn_date", "txn_hour")
    return txns.select(
        "*",
        F.row_number().over(life).cast("bigint").alias("sender_lifetime_rank"),
        F.row_number().over(day).cast("bigint").alias("sender_daily_rank"),
        F.count("*").over(whole_hour).alias("sender_hour_txns"),
        F.count("*").over(whole_day).alias("sender_day_txns"),
        F.count_if(_is_failed()).over(whole_day).alias("sender_day_failures"),
    )


def _ranked_in_slices(txns: DataFrame, policy: SkewPolicy) -> DataFrame:
    sliced = txns.withColumns({
        "_owner": same_key("sender_vpa"),
        "_slice": F.when(F.col("_hot"), second_number(F.col("txn_timestamp"))),
        "_piece": F.lit(0),
    })
    slices = _slice_counts(sliced)
    sliced, cut = _cut_large(sliced, slices, policy)
    if cut:
        slices = _slice_counts(sliced)
    joined = _ranked(sliced, list(_SLICE)).join(_slice_offsets(slices), list(_SLICE), "left")

    def moved(rank: str, offset: str) -> Column:
        return F.col(rank) + F.coalesce(F.col(offset), F.lit(0))

    return joined.withColumns({
        "sender_lifetime_rank": moved("sender_lifetime_rank", "_before_life"),
        "sender_daily_rank": moved("sender_daily_rank", "_before_day"),
        **{c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in COUNTS},
    }).drop(*_SLICE, "_hot", "_before_life", "_before_day", *[f"_{c}" for c in COUNTS])


def _slice_counts(sliced: DataFrame) -> DataFrame:
    """Rows and failures per slice; stored, since plans read it twice and it is far smaller than the rows."""
    return stored(sliced.where("_hot").groupBy(*_HOUR, "_slice", "_piece").agg(
        F.count("*").alias("_n"), F.count_if(_is_failed()).alias("_failed"),
    ), "slices")


def _cut_large(sliced: DataFrame, slices: DataFrame, policy: SkewPolicy) -> tuple[DataFrame, bool]:
    """Number the pieces of slices too large for a task, in the order of (time, id).

    Such rows are written out once: that fixes the borders, which come from a sample.
    """
    total = slices.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    least = max(policy.min_rows, total // policy.max_keys, 1)
    large = slices.where(F.col("_n") > least)
    rows = large.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if not rows:
        return sliced, False
    keys = F.broadcast(large.select("_owner", "_slice"))  # fewer than policy.max_keys
    pieces = (
        sliced.join(keys, ["_owner", "_slice"], "left_semi")
        .repartitionByRange(rows // least + 1, "_owner", "txn_timestamp", "txn_id")
        .withColumn("_piece", F.spark_partition_id())
    )
    rest = sliced.join(keys, ["_owner", "_slice"], "left_anti")
    return rest.unionByName(stored(pieces, "pieces")), True


def _slice_offsets(slices: DataFrame) -> DataFrame:
    hours = slices.groupBy(*_HOUR).agg(F.sum("_n").alias("_hour_n"), F.sum("_failed").alias("_hour_failed"))

    before = (Window.unboundedPreceding, -1)
    life = Window.partitionBy("_owner").orderBy("txn_date", "txn_hour").rowsBetween(*before)
    day = Window.partitionBy("_owner", "txn_date").orderBy("txn_hour").rowsBetween(*before)
    whole_day = Window.partitionBy("_owner", "txn_date")
    in_hour = Window.partitionBy(*_HOUR).orderBy("_slice", "_piece").rowsBetween(*before)

    def zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0))

    hours = hours.select(
        *_HOUR,
        zero(F.sum("_hour_n").over(life)).alias("_hours_life"),
        zero(F.sum("_hour_n").over(day)).alias("_hours_day"),
        F.col("_hour_n").alias("_sender_hour_txns"),
        F.sum("_hour_n").over(whole_day).alias("_sender_day_txns"),
        F.sum("_hour_failed").over(whole_day).alias("_sender_day_failures"),
    )
    slices = slices.select(*_HOUR, "_slice", "_piece", zero(F.sum("_n").over(in_hour)).alias("_in_hour"))
    return slices.join(hours, list(_HOUR)).select(
        *_SLICE,
        (F.col("_hours_life") + F.col("_in_hour")).alias("_before_life"),
        (F.col("_hours_day") + F.col("_in_hour")).alias("_before_day"),
        *[f"_{c}" for c in COUNTS],
    )
