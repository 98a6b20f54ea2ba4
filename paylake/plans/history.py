"""Customer history over a range of dates in one job chain.

The loop computes every sender's profile anew for each date. Here each sender gets one row for each
snapshot that its transactions first show in, with what they add; running totals over these rows are
the profiles on all dates at once. A distinct count grows with the first appearances of its values.
The most frequent value on a date is the best of all (count so far, value) pairs up to it, since
counts only grow. Versions are the islands of equal tracked attributes.

Everything is combined by sender and snapshot before a window sees it, so a window holds as many rows
of a sender as there are snapshots, however many transactions there are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paylake.fixed import TRACKED_CUSTOMER_COLUMNS
from paylake.functions import classify
from paylake.functions.numbers import safe_divide
from paylake.operators.partitions import replace_partitions, table_exists
from paylake.operators.scratch import stored_for
from paylake.operators.versions import CLOSED_ON, OPEN_DAY, ClockWentBack, opened
from paylake.plans.customers import MODES

_KEYS = ("sender_vpa", "primary_bank")
_SUMS = ("total_txns", "success_count", "failed_count", "reversed_count", "high_value_count", "off_hours_count", "suspicious_txn_count", "active_days")


def first_seen(day: Column, dates: Sequence[dt.date]) -> Column:
    """Number, from 1, of the first of the ascending dates that is not before ``day``; null after the last."""
    calendar, n = [], 0
    for k in range((dates[-1] - dates[0]).days + 1):
        n += dates[n] < dates[0] + dt.timedelta(days=k)
        calendar.append(n + 1)
    place = F.greatest(F.datediff(day, F.lit(dates[0])), F.lit(0)) + 1
    return F.try_element_at(F.array(*map(F.lit, calendar)), place)


def _added(txns: DataFrame) -> DataFrame:
    """What the transactions of each snapshot add to a sender's profile."""
    spend = F.col("amount_inr")
    return txns.groupBy(*_KEYS, "snap").agg(
        F.min("txn_date").alias("first_txn_date"), F.max("txn_date").alias("last_txn_date"), F.max(spend).alias("max_single_txn_inr"),
        F.sum(spend).alias("total_spend_inr"), F.count(spend).alias("spends"), F.count("txn_id").alias("total_txns"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"), F.count_if(F.col("status") == "FAILED").alias("failed_count"),
        F.count_if(F.col("status") == "REVERSED").alias("reversed_count"), F.count_if("is_high_value").alias("high_value_count"),
        F.count_if("is_off_hours").alias("off_hours_count"), F.count_if("is_suspicious").alias("suspicious_txn_count"),
        F.count_distinct("txn_date").alias("active_days"))


def _appearances(txns: DataFrame, column: str, name: str) -> DataFrame:
    """How many values of a column a sender shows for the first time in each snapshot."""
    first = txns.where(F.col(column).isNotNull()).groupBy(*_KEYS, column).agg(F.min("snap").alias("snap"))
    return first.groupBy(*_KEYS, "snap").agg(F.count("*").alias(name))


def _leaders(txns: DataFrame) -> DataFrame:
    """The best city and device among those that each snapshot adds to, by their counts so far."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in MODES])).alias("m")
    counts = txns.where("sender_vpa is not null").select("sender_vpa", "snap", kinds).select("sender_vpa", "snap", "m.*").where(
        (F.col("kind") != "city") | F.col("value").isNotNull()).groupBy("sender_vpa", "kind", "value", "snap").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("sender_vpa", "kind", "value").orderBy("snap")
    place = F.struct((-F.sum("n").over(so_far)).alias("n"), F.col("value").isNull().alias("missing"), "value")
    return counts.select("sender_vpa", "snap", "kind", place.alias("place")).groupBy("sender_vpa", "snap").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("place"))).alias(name) for k, name in MODES.items()])


def _joined(rows: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    more = more.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(more, same, "left").drop(*[f"_{k}" for k in keys])


def profiles(txns: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Profile of each sender as of every date (``snap`` numbers them from 1) on which it changed."""
    seen = txns.withColumn("snap", first_seen(F.col("txn_date"), dates)).where("snap is not null").withColumnRenamed("sender_bank", "primary_bank")
    rows = _added(seen)
    for column, name in (("receiver_vpa", "unique_payees"), ("city", "cities_transacted")):
        rows = _joined(rows, _appearances(seen, column, name), [*_KEYS, "snap"])
    rows = _joined(rows, _leaders(seen), ["sender_vpa", "snap"])
    up_to = Window.partitionBy(*_KEYS).orderBy("snap")
    sums = {c: F.sum(c).over(up_to) for c in (*_SUMS, "spends")}
    sums |= {c: F.coalesce(F.sum(c).over(up_to), F.lit(0)) for c in ("unique_payees", "cities_transacted")}
    return rows.withColumns({
        **sums, "total_spend_inr": F.sum("total_spend_inr").over(up_to).cast("decimal(38,2)"),
        "first_txn_date": F.min("first_txn_date").over(up_to), "last_txn_date": F.max("last_txn_date").over(up_to),
        "max_single_txn_inr": F.max("max_single_txn_inr").over(up_to), **{name: F.min(name).over(up_to)["value"] for name in MODES.values()},
    }).withColumns({
        "avg_txn_amount_inr": F.col("total_spend_inr").cast("double") / F.col("spends").cast("double"),
        "customer_tier": classify.customer_tier(F.col("total_spend_inr")),
        "success_rate": safe_divide(F.col("success_count"), F.col("total_txns")),
        "failure_rate": safe_divide(F.col("failed_count"), F.col("total_txns")),
    }).drop("spends")


def _versions(states: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """States that differ from the one before, or are stored already, each ended by the next."""
    in_turn = Window.partitionBy(key).orderBy("dbt_valid_from", F.desc("stored"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lag(c).over(in_turn)) for c in tracked])
    kept = states.withColumn("_new", F.col("stored") | (F.row_number().over(in_turn) == 1) | ~same).where("_new").drop("_new")
    return kept.withColumn("dbt_valid_to", F.lead("dbt_valid_from").over(in_turn))


def snapshot_range(
    txns: DataFrame, path: str, snapshots: Sequence[tuple[dt.date, dt.datetime]], tracked: Sequence[str] = TRACKED_CUSTOMER_COLUMNS,
) -> None:
    """Bring the customer history at ``path`` up to the last of the snapshots: (date, instant), ascending.

    The table is the same as after a snapshot at each instant of the profiles of all flagged
    transactions up to its date. Versions that were open are ended or go on; those ended before stay.
    An instant before the newest version raises ``ClockWentBack``.
    """
    spark: SparkSession = txns.sparkSession
    dates, instants = [d for d, _ in snapshots], [t for _, t in snapshots]
    if dates != sorted(set(dates)) or instants != sorted(set(instants)):
        raise ValueError("snapshots must be ascending by date and instant")
    states = profiles(txns, dates)
    at = F.element_at(F.array(*[F.lit(t.strftime("%Y-%m-%d %H:%M:%S")) for t in instants]), F.col("snap"))
    new = opened(states, "sender_vpa", at).drop("snap").withColumn("stored", F.lit(False))
    exists, ended = table_exists(spark, path), None
    if exists:
        table = spark.read.parquet(path)
        open_rows = table.where(F.col(CLOSED_ON) == OPEN_DAY).drop(CLOSED_ON)
        newest = open_rows.agg(F.max("dbt_valid_from")).first()[0]
        if newest is not None and instants[0] < newest:
            raise ClockWentBack(f"snapshot at {instants[0]}, but a version begins at {newest}")
        # Ended on one of these days by an earlier run, or by one that stopped between the two writes below.
        days = sorted({t.date() for t in instants})
        ended = table.where(F.col(CLOSED_ON).isin(days)).drop(CLOSED_ON).join(open_rows.select("dbt_scd_id"), "dbt_scd_id", "left_anti")
        new = open_rows.withColumn("stored", F.lit(True)).unionByName(new)
    rows = _versions(new, "sender_vpa", tracked).drop("stored")
    rows = rows.unionByName(ended) if ended is not None else rows
    ended_on = F.coalesce(F.to_date("dbt_valid_to"), F.lit(OPEN_DAY)).alias(CLOSED_ON)
    with stored_for(rows.select("*", ended_on), "versions") as rows:
        if not exists:
            rows.write.partitionBy(CLOSED_ON).mode("errorifexists").parquet(path)
            return
        replace_partitions(rows, path, CLOSED_ON, days)
        replace_partitions(rows, path, CLOSED_ON, [OPEN_DAY])
