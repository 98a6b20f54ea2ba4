"""Names, vocabularies, limits and texts that results depend on."""

from decimal import Decimal

# Columns of a landed transaction, in order.
CANONICAL_COLUMNS = (
    "txn_id", "upi_ref", "sender_vpa", "receiver_vpa", "amount", "currency", "status",
    "txn_timestamp", "device_type", "device_id", "ip_address", "city", "remarks", "ingested_at",
)

# Columns without which a delivery cannot be used.
REQUIRED_COLUMNS = ("txn_id", "sender_vpa", "receiver_vpa", "amount", "txn_timestamp")

# Accepted statement headers and the column each one stands for.
HEADER_ALIASES = {
    "transaction_id": "txn_id",
    "txn_id": "txn_id",
    "upi_reference": "upi_ref",
    "upi_ref": "upi_ref",
    "from_vpa": "sender_vpa",
    "sender_vpa": "sender_vpa",
    "to_vpa": "receiver_vpa",
    "receiver_vpa": "receiver_vpa",
    "txn_amount": "amount",
    "amount": "amount",
    "currency": "currency",
    "txn_status": "status",
    "status": "status",
    "timestamp": "txn_timestamp",
    "txn_timestamp": "txn_timestamp",
    "device": "device_type",
    "device_type": "device_type",
    "device_id": "device_id",
    "ip": "ip_address",
    "ip_address": "ip_address",
    "city": "city",
    "remarks": "remarks",
    "ingested_at": "ingested_at",
}

# Texts that mean "no value" in a statement file (pandas' documented defaults).
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Longest text the raw table takes, by column.
RAW_TEXT_LIMITS = {
    "txn_id": 36,
    "upi_ref": 50,
    "sender_vpa": 100,
    "receiver_vpa": 100,
    "currency": 3,
    "status": 20,
    "device_type": 20,
    "device_id": 50,
    "ip_address": 45,
    "city": 50,
    "remarks": 200,
}

DEFAULT_CURRENCY = "INR"
SOURCES = ("csv", "api")

# Status spellings and the status each one stands for; the rest is UNKNOWN.
STATUS_SPELLINGS = {
    "SUCCESS": "SUCCESS",
    "COMPLETED": "SUCCESS",
    "FAILED": "FAILED",
    "FAILURE": "FAILED",
    "ERROR": "FAILED",
    "PENDING": "PENDING",
    "REVERSED": "REVERSED",
    "REFUNDED": "REVERSED",
}
UNKNOWN_STATUS = "UNKNOWN"
RAW_STATUSES = ("SUCCESS", "FAILED", "PENDING", "REVERSED")
STATUSES = RAW_STATUSES + (UNKNOWN_STATUS,)

# Amounts below the bound fall in the bucket; the rest is HIGH_VALUE.
SIZE_BUCKETS = (("MICRO", 100), ("SMALL", 1000), ("MEDIUM", 10000), ("LARGE", 50000))
TOP_SIZE_BUCKET = "HIGH_VALUE"

# Last hour of each part of the day.
DAY_PARTS = (("NIGHT", 5), ("MORNING", 11), ("AFTERNOON", 17), ("EVENING", 23))

# Lifetime spend that reaches the tier; the rest is BRONZE.
CUSTOMER_TIERS = (("PLATINUM", 1000000), ("GOLD", 100000), ("SILVER", 10000))
BASE_CUSTOMER_TIER = "BRONZE"

# Fraud score that reaches the tier; the rest is LOW.
RISK_TIERS = (("CRITICAL", Decimal("0.8")), ("HIGH", Decimal("0.5")), ("MEDIUM", Decimal("0.2")))
BASE_RISK_TIER = "LOW"

# Fraud rules with score and reason.
HIGH_VALUE_OFF_HOURS = ("HIGH_VALUE_OFF_HOURS", Decimal("0.85"), "amount > 50K AND hour 0-5")
RAPID_REPEAT_SENDER = ("RAPID_REPEAT_SENDER", Decimal("0.75"), "sender sent {n} txns in 1 hour")
ALWAYS_FAILED_SENDER = (
    "ALWAYS_FAILED_SENDER", Decimal("0.70"), "100% failure rate sender (≥5 daily txns)",
)
HIGH_VALUE_REVERSAL = (
    "HIGH_VALUE_REVERSAL", Decimal("0.65"), "Reversed transaction with amount > 50K",
)
CROSS_BANK_HIGH_VALUE = ("CROSS_BANK_HIGH_VALUE", Decimal("0.60"), "High-value cross-bank transfer")
SIGNAL_TYPES = (
    "HIGH_VALUE_OFF_HOURS",
    "RAPID_REPEAT_SENDER",
    "ALWAYS_FAILED_SENDER",
    "HIGH_VALUE_REVERSAL",
    "CROSS_BANK_HIGH_VALUE",
)

# Shape of a well-formed payment address.
VPA_PATTERN = "^[a-zA-Z0-9._-]+@[a-zA-Z]+$"

# Characters after which a word starts (besides white space).
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

# Customer attributes whose change opens a new version.
TRACKED_CUSTOMER_COLUMNS = ("primary_bank", "customer_tier", "home_city", "primary_device_type")

# Names of the rules on sliding velocity and first meetings.
BURST_SENDER = "BURST_SENDER"
NEW_PAYEE_HIGH_VALUE = "NEW_PAYEE_HIGH_VALUE"
NEW_CITY_HIGH_VALUE = "NEW_CITY_HIGH_VALUE"
