"""Sliding velocity of a sender, and payees and cities it meets for the first time.

Velocity counts the transactions of the last five minutes, second by second: those of the seconds
from 300 before to the transaction's own. So windows run over counts by second, at most 86,400 and a
halo for a sender and day, whatever the number of transactions. Each day is a slice of its own; the
seconds in its last five minutes are also put in front of the next one. All senders go one way, hot
or not.

First meetings are found by a minimum over (time, id) for each pair, which combines before its
shuffle, and are told to their transactions by id, which is never a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake import fixed
from paylake.config import Run
from paylake.functions.calendar import second_number
from paylake.operators.skew import same_key

SPAN = 300  # seconds
_DAY = 86_400


def by_second(txns: DataFrame) -> DataFrame:
    """Transactions and amount of each sender's last SPAN seconds, for every second it is active in."""
    owner, second = same_key("sender_vpa").alias("_owner"), second_number(F.col("txn_timestamp")).alias("_second")
    counts = txns.groupBy(owner, second).agg(F.count("*").alias("_n"), F.sum("amount_inr").alias("_sum"))
    day = F.floor(F.col("_second") / _DAY)
    late = F.col("_second") - day * _DAY >= _DAY - SPAN
    placed = counts.withColumn("_day", day).withColumn(
        "_slice", F.explode(F.when(late, F.array(F.col("_day"), F.col("_day") + 1)).otherwise(F.array("_day"))))
    span = Window.partitionBy("_owner", "_slice").orderBy("_second").rangeBetween(-SPAN, 0)
    return placed.select(
        "_owner", "_second", "_slice", "_day", F.sum("_n").over(span).alias("sender_5min_txns"),
        F.sum("_sum").over(span).cast("decimal(38,2)").alias("sender_5min_amount_inr"),
    ).where("_slice = _day").drop("_slice", "_day")


def first_meetings(txns: DataFrame, other: str, flag: str) -> DataFrame:
    """_id of the transactions in which a sender meets a value of ``other`` for the first time, with ``flag``."""
    pair = txns.where(F.col("sender_vpa").isNotNull() & F.col(other).isNotNull())
    first = pair.groupBy("sender_vpa", other).agg(F.min(F.struct("txn_timestamp", "txn_id")).alias("first"))
    return first.select(F.col("first.txn_id").alias("_id"), F.lit(True).alias(flag))


def sender_velocity(txns: DataFrame) -> DataFrame:
    """``txns`` with the sender's figures of the last five minutes and the flags of first meetings.

    Reads its input four times, so it should be a stored table.
    """
    rows = txns.withColumns({"_own": same_key("sender_vpa"), "_at": second_number(F.col("txn_timestamp"))})
    rows = rows.join(by_second(txns), (F.col("_own") == F.col("_owner")) & (F.col("_at") == F.col("_second"))).drop("_own", "_at", "_owner", "_second")
    meetings = first_meetings(txns, "receiver_vpa", "is_new_payee").unionByName(first_meetings(txns, "city", "is_new_city"), allowMissingColumns=True)
    flags = ("is_new_payee", "is_new_city")
    meetings = meetings.groupBy("_id").agg(*[F.max(f).alias(f) for f in flags])
    return rows.join(meetings, F.col("txn_id") == F.col("_id"), "left").drop("_id").withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def _rules(run: Run) -> dict[str, Column]:
    known, high = F.col("sender_vpa").isNotNull(), F.col("is_high_value")
    return {
        fixed.BURST_SENDER: known & (F.col("sender_5min_txns") >= run.settings.burst_min_txns),
        fixed.NEW_PAYEE_HIGH_VALUE: F.col("is_new_payee") & high,
        fixed.NEW_CITY_HIGH_VALUE: F.col("is_new_city") & high,
    }


def velocity_signals(velocity: DataFrame, run: Run) -> DataFrame:
    """One row per transaction and rule it breaks, beside the rules of ``fct_fraud_signals``."""
    broken = F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, when in _rules(run).items()]))
    return velocity.select(
        "txn_id", "sender_vpa", "txn_date", "amount_inr", "txn_timestamp", "sender_5min_txns", "sender_5min_amount_inr",
        F.explode(broken).alias("signal_type"))
