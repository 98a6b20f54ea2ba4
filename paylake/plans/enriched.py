"""int_transactions_enriched: staging plus risk flags, calendar parts and sender ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.config import Run
from paylake.functions import classify
from paylake.operators.skew import hot_keys
from paylake.operators.timeline import COUNTS, with_sender_timeline


def with_flags(stg: DataFrame) -> DataFrame:
    same_bank = F.col("sender_bank") == F.col("receiver_bank")
    same_start = F.left("sender_vpa", F.lit(3)) == F.left("receiver_vpa", F.lit(3))
    return stg.withColumns({
        "txn_size_bucket": classify.size_bucket(F.col("amount_inr")),
        "is_cross_bank": F.col("sender_bank") != F.col("receiver_bank"),
        "is_self_transfer": same_bank & same_start,
        "day_part": classify.day_part(F.col("txn_hour")),
        "is_suspicious": F.col("is_high_value") & F.col("is_off_hours"),
        "txn_month": F.month("txn_date").cast("bigint"),
        "txn_week": F.weekofyear("txn_date").cast("bigint"),
        "txn_year": F.year("txn_date").cast("bigint"),
    })


def hot_senders(rows: DataFrame, run: Run, sender: Column | None = None) -> DataFrame | None:
    """Senders too large for one task. Counting raw rows is enough: there are never fewer of them."""
    key = F.col("sender_vpa") if sender is None else sender
    return hot_keys(rows, {"sender_vpa": key}, run.settings.skew)


def features(stg: DataFrame, run: Run, hot: DataFrame | None = None) -> DataFrame:
    """Enriched rows plus the sender counts the fraud rules read."""
    return with_sender_timeline(with_flags(stg), hot, run.settings.skew)


def enrich(stg: DataFrame, run: Run, hot: DataFrame | None = None) -> DataFrame:
    return features(stg, run, hot).drop(*COUNTS)
