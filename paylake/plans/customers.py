"""int_customers_current and dim_customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paylake.functions import classify
from paylake.functions.numbers import mean, safe_divide, total

MODES = {"city": "home_city", "device_type": "primary_device_type"}


def sender_modes(txns: DataFrame) -> DataFrame:
    """Most frequent city and device of every sender, ties to the smallest value.

    A missing city never wins; a missing device competes like any other, last in ties.
    One pass for both: values are counted in long form, and the best one is a plain
    minimum, so both steps combine before their shuffle.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in MODES])).alias("m")
    counts = (
        txns.select("sender_vpa", kinds).select("sender_vpa", "m.kind", "m.value")
        .where((F.col("kind") != "city") | F.col("value").isNotNull())
        .groupBy("sender_vpa", "kind", "value").agg(F.count("*").alias("n"))
    )
    place = F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("missing"), "value")
    return counts.groupBy("sender_vpa").agg(
        *[F.min(F.when(F.col("kind") == k, place))["value"].alias(name) for k, name in MODES.items()])


def customers_current(txns: DataFrame) -> DataFrame:
    """Lifetime profile of every sender over flagged transactions."""
    spend = F.col("amount_inr")
    profile = txns.groupBy("sender_vpa", F.col("sender_bank").alias("primary_bank")).agg(
        F.min("txn_date").alias("first_txn_date"),
        F.max("txn_date").alias("last_txn_date"),
        F.count_distinct("txn_date").alias("active_days"),
        F.count("txn_id").alias("total_txns"),
        total(spend).alias("total_spend_inr"),
        mean(spend).alias("avg_txn_amount_inr"),
        F.max(spend).alias("max_single_txn_inr"),
        F.count_distinct("receiver_vpa").alias("unique_payees"),
        F.count_distinct("city").alias("cities_transacted"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_count"),
        F.count_if(F.col("status") == "REVERSED").alias("reversed_count"),
        F.count_if("is_high_value").alias("high_value_count"),
        F.count_if("is_off_hours").alias("off_hours_count"),
        F.count_if("is_suspicious").alias("suspicious_txn_count"),
    ).withColumns({
        "customer_tier": classify.customer_tier(F.col("total_spend_inr")),
        "success_rate": safe_divide(F.col("success_count"), F.col("total_txns")),
        "failure_rate": safe_divide(F.col("failed_count"), F.col("total_txns")),
    })
    # A plain equality join, as for the profile a null sender has no city or device.
    return profile.join(sender_modes(txns), "sender_vpa", "left")


def dim_customers(versions: DataFrame) -> DataFrame:
    return versions.select(
        F.col("sender_vpa").alias("customer_vpa"), "primary_bank", "first_txn_date", "last_txn_date",
        "total_txns", "total_spend_inr", "customer_tier", "home_city", "primary_device_type",
        "success_rate", "failure_rate",
        F.col("dbt_valid_from").alias("valid_from"), F.col("dbt_valid_to").alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )
