"""Expressions on the values where engines differ."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylake.config import namespace
from paylake.functions import calendar, classify, numbers, text


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


@pytest.mark.parametrize("vpa,bank,valid", [
    ("a@b", "b", True), ("a@", None, False), ("plain", "plain", False), ("a@b@c", "c", False),
    (" A@B ", "b", False), (None, None, None), ("a.b_c-1@OkAxis", "okaxis", True), ("a@b1", "b1", False),
    ("a@ ", "", False), ("", None, False), ("@", None, False),
])
def test_vpa(spark, vpa, bank, valid):
    row = spark.createDataFrame([(vpa,)], "v string").select(text.bank_handle(F.col("v")), text.is_valid_vpa(F.col("v"))).first()
    assert (row[0], row[1]) == (bank, valid)


def test_proper_case(spark):
    words = ["new-delhi", "navi mumbai", "ST. john's", "a(b)c", "", None, "o_p/q", "UPPER  twice", "tab\tbed", "x&y [z]"]
    got = values(spark, [(w,) for w in words], "v string", text.proper_case(F.col("v")))
    assert got == ["New-Delhi", "Navi Mumbai", "St. John's", "A(B)C", "", None, "O_P/Q", "Upper  Twice", "Tab\tBed", "X&Y [Z]"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minute_boundaries_in_any_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = [
            ("2024-03-10 00:00:59", "2024-03-10 00:01:01", 1),
            ("2024-03-10 00:00:01", "2024-03-10 00:00:59", 0),
            ("2024-03-10 01:59:00", "2024-03-10 03:00:00", 61),
            ("2024-12-31 23:59:59", "2025-01-01 00:00:00", 1),
        ]
        df = spark.createDataFrame(pairs, "a string, b string, n int")
        a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
        rows = df.select(calendar.minute_boundaries(a, b).alias("got"), "n", (calendar.second_number(b) - calendar.second_number(a)).alias("s")).collect()
        assert [r.got for r in rows] == [r.n for r in rows]
        assert [r.s for r in rows] == [2, 58, 3660, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(spark):
    day = F.lit(dt.date(2024, 12, 30))
    row = spark.range(1).select(F.weekofyear(day), F.year(day), calendar.day_of_week(F.lit(dt.date(2024, 1, 7)))).first()
    assert tuple(row) == (1, 2024, 0)


def test_size_buckets(spark):
    amounts = ["99.99", "100", "999.99", "1000", "9999.99", "10000", "49999.99", "50000", "50000.01"]
    got = values(spark, [(Decimal(a),) for a in amounts], "v decimal(15,2)", classify.size_bucket(F.col("v")))
    assert got == ["MICRO", "SMALL", "SMALL", "MEDIUM", "MEDIUM", "LARGE", "LARGE", "HIGH_VALUE", "HIGH_VALUE"]


def test_status(spark):
    spelled = [" completed ", "Failure", "error", "refunded", "pending", "SUCCESS", "odd", None]
    got = values(spark, [(s,) for s in spelled], "v string", classify.status(F.col("v")))
    assert got == ["SUCCESS", "FAILED", "FAILED", "REVERSED", "PENDING", "SUCCESS", "UNKNOWN", "UNKNOWN"]


def test_tiers(spark):
    spend = [(Decimal(v),) for v in ("1000000", "999999.99", "100000", "10000", "9999.99")]
    assert values(spark, spend, "v decimal(38,2)", classify.customer_tier(F.col("v"))) == ["PLATINUM", "GOLD", "GOLD", "SILVER", "BRONZE"]
    score = [(Decimal(v),) for v in ("0.80", "0.79", "0.50", "0.20", "0.19")]
    assert values(spark, score, "v decimal(3,2)", classify.risk_tier(F.col("v"))) == ["CRITICAL", "HIGH", "HIGH", "MEDIUM", "LOW"]
    assert values(spark, [(0,), (5,), (6,), (12,), (18,), (None,)], "v bigint", classify.day_part(F.col("v"))) == [
        "NIGHT", "NIGHT", "MORNING", "AFTERNOON", "EVENING", None]


def test_numbers(spark):
    pairs = [(1, 0), (1, None), (None, 2), (1, 4)]
    assert values(spark, pairs, "a bigint, b bigint", numbers.safe_divide(F.col("a"), F.col("b"))) == [0.0, 0.0, None, 0.25]
    assert values(spark, [(12345,), (-1,), (None,)], "p bigint", numbers.paisa_to_inr(F.col("p"))) == [Decimal("123.45"), Decimal("-0.01"), None]


def test_namespace():
    assert namespace(None, "prod", "base") == "base"
    assert namespace(" marts ", "prod", "base") == "marts"
    assert namespace("marts", "dev", "base") == "base_marts"
