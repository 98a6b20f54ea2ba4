"""The declared rules."""

from __future__ import annotations

from dataclasses import dataclass

from paylake import fixed

_TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
_BUCKETS = tuple(name for name, _ in fixed.SIZE_BUCKETS) + (fixed.TOP_SIZE_BUCKET,)


@dataclass(frozen=True)
class Rule:
    relation: str
    column: str
    check: str  # not_null, unique, accepted_values, assert_positive, no_negative, no_future
    values: tuple[str, ...] = ()
    severity: str = "error"


def _rules(relation: str, check: str, *columns: str, values: tuple[str, ...] = (), severity: str = "error") -> list[Rule]:
    return [Rule(relation, c, check, values, severity) for c in columns]


# Statuses arrive in more spellings than the raw rule lists, hence only a warning.
RULES: list[Rule] = [
    *_rules("raw_upi_transactions", "not_null", "txn_id", "txn_timestamp"),
    *_rules("raw_upi_transactions", "unique", "txn_id"),
    *_rules("raw_upi_transactions", "accepted_values", "status", values=fixed.RAW_STATUSES, severity="warn"),
    *_rules("stg_upi_transactions", "not_null", "txn_id", "amount_inr", "status", "sender_vpa", "receiver_vpa",
            "txn_date", "sender_bank", "receiver_bank"),
    *_rules("stg_upi_transactions", "unique", "txn_id"),
    *_rules("stg_upi_transactions", "accepted_values", "status", values=fixed.STATUSES),
    *_rules("stg_upi_transactions", "no_negative", "amount_inr"),
    *_rules("stg_upi_transactions", "no_future", "txn_timestamp"),
    *_rules("fct_transactions", "not_null", "txn_id", "sender_vpa", "receiver_vpa", "txn_date"),
    *_rules("fct_transactions", "unique", "txn_id"),
    *_rules("fct_transactions", "assert_positive", "amount_inr"),
    *_rules("fct_transactions", "accepted_values", "status", values=fixed.STATUSES),
    *_rules("fct_transactions", "accepted_values", "txn_size_bucket", values=_BUCKETS),
    *_rules("fct_daily_summary", "not_null", "txn_date"),
    *_rules("fct_daily_summary", "assert_positive", "txn_count"),
    *_rules("dim_customers", "not_null", "customer_vpa", "primary_bank", "first_txn_date", "last_txn_date"),
    *_rules("dim_customers", "unique", "customer_vpa"),
    *_rules("dim_customers", "assert_positive", "total_txns"),
    *_rules("dim_customers", "accepted_values", "customer_tier", values=_TIERS),
    *_rules("fct_customer_activity", "not_null", "sender_vpa", "txn_date"),
    *_rules("fct_customer_activity", "assert_positive", "daily_txn_count"),
    *_rules("fct_fraud_signals", "not_null", "txn_id", "signal_type", "signal_reason", "sender_vpa", "txn_date"),
    *_rules("fct_fraud_signals", "accepted_values", "signal_type", values=fixed.SIGNAL_TYPES),
    *_rules("fct_fraud_summary", "not_null", "txn_date", "signal_type"),
    *_rules("fct_fraud_summary", "assert_positive", "flagged_txn_count"),
]
