"""Facts of touched days alone, with lifetime ranks that go on from stored counts.

Transactions of a sender are counted by day in a small table. The lifetime rank of a transaction is its
rank in its day plus what the sender had on earlier days, so a day can be built without the days
before it. A day has to be built again if its rows changed, if a sender's count changed on an
earlier day, which moves the sender's later ranks, or if the current version of a sender changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from paylake.config import Run
from paylake.operators.timeline import COUNTS
from paylake.plans import enriched


def counts_by_day(stg: DataFrame) -> DataFrame:
    """sender_vpa, txn_date and n; null senders are one sender, as they are for the ranks."""
    return stg.groupBy("sender_vpa", "txn_date").agg(F.count("*").alias("n"))


def _by_sender(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    return rows.join(other, F.col("sender_vpa").eqNullSafe(F.col("_sender")), how)


def days_to_build(days: Sequence[dt.date], before: DataFrame, now: DataFrame, versions_before: DataFrame, versions_now: DataFrame) -> list[dt.date]:
    """``days`` and those that follow from them.

    ``before`` and ``now``: counts by day of all days, before and after. ``versions_*``: sender_vpa and
    dbt_scd_id of the current version of every sender that the facts show, before and after.
    """
    old = before.where(F.col("txn_date").isin(list(days))).select(F.col("sender_vpa").alias("_sender"), F.col("txn_date").alias("_day"), F.col("n").alias("_n"))
    new = now.where(F.col("txn_date").isin(list(days)))
    both = new.join(old, F.col("sender_vpa").eqNullSafe(F.col("_sender")) & (F.col("txn_date") == F.col("_day")), "full_outer")
    differs = both.where(~F.col("n").eqNullSafe(F.col("_n"))).select(
        F.when(F.col("_day").isNull(), F.col("sender_vpa")).otherwise(F.col("_sender")).alias("_sender"), F.coalesce("txn_date", "_day").alias("_from"))
    first = differs.groupBy("_sender").agg(F.min("_from").alias("_from"))
    later = _by_sender(now, first, "inner").where("txn_date > _from").select("txn_date")

    was = versions_before.select(F.col("sender_vpa").alias("_v"), F.col("dbt_scd_id").alias("_id"))
    pairs = versions_now.join(was, F.col("sender_vpa").eqNullSafe(F.col("_v")), "full_outer")
    moved = pairs.where(~F.col("dbt_scd_id").eqNullSafe(F.col("_id"))).select(F.coalesce("sender_vpa", "_v").alias("_sender")).where("_sender is not null")
    shown = _by_sender(now, moved, "left_semi").select("txn_date")
    return sorted({*days, *(r[0] for r in later.union(shown).distinct().collect())})


def features_of_days(stg: DataFrame, counts: DataFrame, days: Sequence[dt.date], run: Run) -> DataFrame:
    """Enriched rows of the days, the same as those of ``enriched.features`` over the whole table."""
    rows = stg.where(F.col("txn_date").isin(list(days)))
    found = enriched.features(rows, run, enriched.hot_senders(rows, run))
    earlier = Window.partitionBy("sender_vpa").orderBy("txn_date").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.where(F.col("txn_date") <= F.lit(max(days))).select(F.col("sender_vpa").alias("_sender"), F.col("txn_date").alias("_day"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_earlier"))
    begun = begun.where(F.col("_day").isin(list(days)))
    same = F.col("sender_vpa").eqNullSafe(F.col("_sender")) & (F.col("txn_date") == F.col("_day"))
    return found.join(begun, same).withColumn("sender_lifetime_rank", F.col("_earlier") + F.col("sender_daily_rank")).drop("_sender", "_day", "_earlier")


def enriched_of_days(stg: DataFrame, counts: DataFrame, days: Sequence[dt.date], run: Run) -> DataFrame:
    return features_of_days(stg, counts, days, run).drop(*COUNTS)
