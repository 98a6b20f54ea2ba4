"""fct_fraud_signals, fct_fraud_scores and fct_fraud_summary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed
from paylake.config import Run
from paylake.functions import classify
from paylake.functions.numbers import mean, safe_divide, total

_SCORE = "decimal(3,2)"


def _cap(score: Column) -> Column:
    return F.least(score, F.lit(Decimal("1.0")))


def _signal(when: Column, rule: tuple[str, Decimal, str], reason: Column | None = None) -> Column:
    name, score, text = rule
    return F.when(when, F.struct(
        F.lit(name).alias("signal_type"),
        F.lit(score).cast(_SCORE).alias("signal_score"),
        (F.lit(text) if reason is None else reason).alias("signal_reason"),
    ))


def _rules(run: Run) -> dict[str, Column]:
    known_sender = F.col("sender_vpa").isNotNull()
    in_hour, in_day = F.col("sender_hour_txns"), F.col("sender_day_txns")
    before, after = fixed.RAPID_REPEAT_SENDER[2].split("{n}")
    reason = F.concat(F.lit(before), in_hour.cast("string"), F.lit(after))
    settings = run.settings
    signals = (
        _signal(F.col("is_high_value") & F.col("txn_hour").between(0, 5), fixed.HIGH_VALUE_OFF_HOURS),
        _signal(known_sender & (in_hour >= settings.velocity_min_txns), fixed.RAPID_REPEAT_SENDER, reason),
        _signal(known_sender & (in_day >= settings.always_failed_min_txns) & (F.col("sender_day_failures") == in_day),
                fixed.ALWAYS_FAILED_SENDER),
        _signal((F.col("status") == "REVERSED") & F.col("is_high_value"), fixed.HIGH_VALUE_REVERSAL),
        _signal(F.col("is_cross_bank") & F.col("is_high_value") & (F.col("status") == "SUCCESS"),
                fixed.CROSS_BANK_HIGH_VALUE),
    )
    return dict(zip(fixed.SIGNAL_TYPES, signals))


def fct_fraud_signals(features: DataFrame, run: Run, only: str | None = None) -> DataFrame:
    """One row per transaction and rule it breaks; ``only`` evaluates a single rule.

    The sender counts are already on the rows, so this is one pass without a shuffle.
    """
    rules = _rules(run)
    chosen = list(rules.values()) if only is None else [rules[only]]
    return features.select(
        "txn_id", "sender_vpa", "txn_date", "amount_inr", "txn_timestamp",
        F.explode(F.array_compact(F.array(*chosen))).alias("signal"),
    ).select("txn_id", "sender_vpa", "txn_date", "amount_inr", "txn_timestamp", "signal.*").withColumn(
        "capped_score", _cap(F.col("signal_score")).cast(_SCORE))


def fct_fraud_scores(signals: DataFrame) -> DataFrame:
    """Combined score and risk tier of every flagged transaction."""
    return signals.groupBy("txn_id", "sender_vpa", "txn_timestamp").agg(
        F.sum("signal_score").cast("decimal(38,2)").alias("total_raw_score"),
        F.count("signal_type").alias("signals_triggered"),
        F.array_sort(F.collect_list("signal_type")).alias("triggered_rules"),
    ).withColumn("fraud_score", _cap(F.col("total_raw_score")).cast(_SCORE)) \
        .withColumn("fraud_risk_tier", classify.risk_tier(F.col("fraud_score")))


def day_totals(stg: DataFrame) -> DataFrame:
    return stg.groupBy("txn_date").agg(F.count("txn_id").alias("day_total_txns"))


def fct_fraud_summary(signals: DataFrame, stg: DataFrame) -> DataFrame:
    """Daily figures per rule and the share of the day's transactions it flagged."""
    amount = F.col("amount_inr")
    figures = signals.groupBy("txn_date", "signal_type").agg(
        F.count("txn_id").alias("flagged_txn_count"),
        F.count_distinct("sender_vpa").alias("unique_flagged_senders"),
        total(amount).alias("total_flagged_amount_inr"),
        mean(amount).alias("avg_flagged_amount_inr"),
        F.max(amount).alias("max_flagged_amount_inr"),
        mean(F.col("signal_score")).alias("avg_signal_score"),
        F.max("signal_score").alias("max_signal_score"),
        F.min("txn_timestamp").alias("earliest_flag_ts"),
        F.max("txn_timestamp").alias("latest_flag_ts"),
    )
    return figures.join(day_totals(stg), "txn_date", "left").withColumn(
        "signal_rate", safe_divide(F.col("flagged_txn_count"), F.col("day_total_txns"))
    ).orderBy(F.desc("txn_date"), F.desc("flagged_txn_count"))
