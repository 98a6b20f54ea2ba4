"""fct_transactions, fct_daily_summary and fct_customer_activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.fixed import SIZE_BUCKETS, TOP_SIZE_BUCKET
from paylake.functions.calendar import minute_boundaries
from paylake.functions.numbers import mean, safe_divide, total
from paylake.operators.asof import as_of
from paylake.operators.median import BOUND, median_by
from paylake.operators.scratch import stored

_FACT_COLUMNS = (
    "txn_id", "upi_ref",
    "sender_vpa", "receiver_vpa", "sender_bank", "receiver_bank",
    "amount_inr", "currency", "txn_size_bucket", "status",
    "txn_timestamp", "txn_date", "txn_hour", "txn_dow", "txn_month", "txn_week", "txn_year", "day_part", "is_weekend",
    "device_type", "device_id", "ip_address", "city", "remarks",
    "is_upi", "is_high_value", "is_off_hours", "is_cross_bank", "is_self_transfer", "is_suspicious",
    "customer_tier", "customer_lifetime_txns", "customer_lifetime_spend",
    "sender_daily_rank", "sender_lifetime_rank",
    "ingested_at", "_source", "_processed_ts",
)

DAILY_KEYS = ["txn_date", "sender_bank", "receiver_bank", "status", "device_type", "day_part", "is_weekend"]


def fct_transactions(enriched: DataFrame, dim: DataFrame, all_versions: bool = False) -> DataFrame:
    """Transactions with their sender's tier and lifetime figures.

    One row per transaction by default; ``all_versions`` joins every version of the
    sender and so repeats a transaction per version. A hot sender's side of the join is
    split by AQE, since the dimension has only a few rows for it.
    """
    customers = dim if all_versions else dim.where("is_current")
    customers = customers.select(
        F.col("customer_vpa").alias("sender_vpa"), "customer_tier",
        F.col("total_txns").alias("customer_lifetime_txns"),
        F.col("total_spend_inr").alias("customer_lifetime_spend"),
    )
    return enriched.join(customers, "sender_vpa", "left").select(*_FACT_COLUMNS)


def fct_transactions_as_of(flagged: DataFrame, dim: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Flagged transactions with the tier and lifetime figures their sender had at the time.

    The version that holds is the last one that began at or before the transaction; one before the
    first snapshot of its sender has none.
    """
    versions = dim.select(F.col("customer_vpa").alias("sender_vpa"), "valid_from", "customer_tier", "total_txns", "total_spend_inr")
    found = as_of(flagged, versions, "sender_vpa", "txn_timestamp", "valid_from", "_version", hot)
    return found.select(
        "txn_id", "sender_vpa", "txn_date", "txn_timestamp", "amount_inr", "status", F.col("_version.valid_from").alias("version_from"),
        F.col("_version.customer_tier").alias("customer_tier"), F.col("_version.total_txns").alias("customer_lifetime_txns"),
        F.col("_version.total_spend_inr").alias("customer_lifetime_spend"))


def _status_counts(*names: str) -> list[Column]:
    return [F.count_if(F.col("status") == n).alias(f"{n.lower()}_count") for n in names]


def _flag_counts() -> list[Column]:
    return [
        F.count_if("is_high_value").alias("high_value_count"),
        F.count_if("is_off_hours").alias("off_hours_count"),
        F.count_if("is_suspicious").alias("suspicious_count"),
        F.count_if("is_cross_bank").alias("cross_bank_count"),
    ]


def _bucket_counts() -> list[Column]:
    names = {name: f"{name.lower()}_count" for name, _ in SIZE_BUCKETS} | {TOP_SIZE_BUCKET: "high_value_bucket_count"}
    return [F.count_if(F.col("txn_size_bucket") == b).alias(c) for b, c in names.items()]


def fct_daily_summary(txns: DataFrame, bound: int = BOUND) -> DataFrame:
    """Daily figures per bank pair, status, device and part of the day, over flagged transactions.

    The median is computed apart: next to distinct counts it would run on the expanded rows
    and lose hash aggregation for all figures. The stored figures also tell the large groups: those of
    more than ``bound`` rows.
    """
    amount = F.col("amount_inr")
    figures = stored(txns.groupBy(*DAILY_KEYS).agg(
        F.count("txn_id").alias("txn_count"),
        total(amount).alias("total_amount_inr"),
        mean(amount).alias("avg_amount_inr"),
        F.max(amount).alias("max_amount_inr"),
        F.min(amount).alias("min_amount_inr"),
        *_status_counts("SUCCESS", "FAILED", "PENDING", "REVERSED"),
        *_flag_counts(),
        F.count_distinct("sender_vpa").alias("unique_senders"),
        F.count_distinct("receiver_vpa").alias("unique_receivers"),
        F.count_distinct("city").alias("cities_active"),
        *_bucket_counts(),
    ), "daily-figures")
    sizes = figures.select(*DAILY_KEYS, F.col("txn_count").alias("rows"))
    medians = median_by(txns, DAILY_KEYS, "amount_inr", "median_amount_inr", sizes, bound)
    medians = medians.select(*[F.col(k).alias(f"_{k}") for k in DAILY_KEYS], "median_amount_inr")
    same_group = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in DAILY_KEYS]
    count = F.col("txn_count")
    return figures.join(medians, same_group).drop(*[f"_{k}" for k in DAILY_KEYS]).withColumns({
        "success_rate": safe_divide(F.col("success_count"), count),
        "failure_rate": safe_divide(F.col("failed_count"), count),
        "risk_rate": safe_divide(F.col("suspicious_count"), count),
    })


def fct_customer_activity(txns: DataFrame) -> DataFrame:
    """Daily figures per sender over flagged transactions."""
    amount = F.col("amount_inr")
    first, last = F.min("txn_timestamp"), F.max("txn_timestamp")
    count = F.col("daily_txn_count")
    return txns.groupBy("sender_vpa", "txn_date", "sender_bank").agg(
        F.count("txn_id").alias("daily_txn_count"),
        total(amount).alias("daily_total_inr"),
        mean(amount).alias("daily_avg_inr"),
        F.max(amount).alias("daily_max_inr"),
        F.count_distinct("receiver_vpa").alias("daily_unique_payees"),
        F.count_distinct("device_type").alias("device_types_used"),
        F.count_distinct("city").alias("cities_used"),
        *_status_counts("SUCCESS", "FAILED", "REVERSED"),
        *_flag_counts(),
        first.alias("first_txn_ts"),
        last.alias("last_txn_ts"),
        minute_boundaries(first, last).alias("activity_span_minutes"),
    ).withColumns({
        "daily_success_rate": safe_divide(F.col("success_count"), count),
        "daily_failure_rate": safe_divide(F.col("failed_count"), count),
        "daily_risk_score": safe_divide(F.col("suspicious_count"), count),
    })
