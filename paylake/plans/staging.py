"""stg_upi_transactions: clean, typed, one row per transaction id."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from paylake.config import Run
from paylake.fixed import CANONICAL_COLUMNS, DEFAULT_CURRENCY
from paylake.functions import calendar, classify, text
from paylake.functions.calendar import ntz
from paylake.operators.latest import first_per_key

_TIE_BREAKS = [c for c in CANONICAL_COLUMNS if c not in ("txn_id", "txn_timestamp")] + ["_source_date", "_source"]


def sender_vpa() -> Column:
    return F.lower(F.trim("sender_vpa"))


def new_rows(raw: DataFrame, high_water: dt.date | None) -> DataFrame:
    """Raw rows of the source dates from the high-water mark on; all of them at first."""
    return raw if high_water is None else raw.where(F.col("_source_date") >= F.lit(high_water))


def stage(raw: DataFrame, run: Run) -> DataFrame:
    """Latest row of every id, cleaned; ids that differ only in padding are one.

    A copy without a timestamp counts as the latest, so it takes its transaction out of
    the result. Ties fall to the other columns in order, which makes the pick repeatable.
    """
    order = [F.col("txn_timestamp").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in _TIE_BREAKS]]
    known = raw.where(F.col("txn_id").isNotNull()).withColumn("_key", F.trim("txn_id"))
    latest = first_per_key(known, ["_key"], [*order, F.col("txn_id")]).drop("_key")
    latest = latest.where(F.col("txn_timestamp").isNotNull())

    hour = F.hour("txn_timestamp")
    weekday = calendar.day_of_week(F.col("txn_timestamp"))
    above = F.col("amount") > F.lit(run.settings.high_value_threshold)
    return latest.select(
        F.trim("txn_id").alias("txn_id"),
        F.trim("upi_ref").alias("upi_ref"),
        sender_vpa().alias("sender_vpa"),
        F.lower(F.trim("receiver_vpa")).alias("receiver_vpa"),
        F.coalesce("amount", F.lit(0).cast("decimal(15,2)")).alias("amount_inr"),
        F.coalesce(F.upper(F.trim("currency")), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        classify.status(F.col("status")).alias("status"),
        "txn_timestamp",
        F.coalesce(F.to_date("txn_timestamp"), "_source_date").alias("txn_date"),
        hour.cast("bigint").alias("txn_hour"),
        weekday.alias("txn_dow"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.col("upi_ref").isNotNull().alias("is_upi"),
        F.coalesce(above, F.lit(False)).alias("is_high_value"),
        (~hour.between(6, 23)).alias("is_off_hours"),
        text.bank_handle(F.col("sender_vpa")).alias("sender_bank"),
        text.bank_handle(F.col("receiver_vpa")).alias("receiver_bank"),
        F.upper(F.trim("device_type")).alias("device_type"),
        F.trim("device_id").alias("device_id"),
        F.trim("ip_address").alias("ip_address"),
        text.proper_case(F.trim("city")).alias("city"),
        F.trim("remarks").alias("remarks"),
        "ingested_at",
        "_source",
        ntz(run.run_ts).alias("_processed_ts"),
    )
