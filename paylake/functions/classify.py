"""Vocabularies and bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from paylake import fixed


def _bands(pairs, test, rest: Column) -> Column:
    """First band whose test holds, in the given order."""
    return reduce(lambda otherwise, p: F.when(test(p[1]), F.lit(p[0])).otherwise(otherwise), reversed(pairs), rest)


def status(c: Column) -> Column:
    text = F.upper(F.trim(c))
    spelled: dict[str, list[str]] = {}
    for spelling, name in fixed.STATUS_SPELLINGS.items():
        spelled.setdefault(name, []).append(spelling)
    return _bands(tuple(spelled.items()), lambda s: text.isin(s), F.lit(fixed.UNKNOWN_STATUS))


def size_bucket(amount: Column) -> Column:
    return _bands(fixed.SIZE_BUCKETS, lambda bound: amount < bound, F.lit(fixed.TOP_SIZE_BUCKET))


def day_part(hour: Column) -> Column:
    return _bands(fixed.DAY_PARTS, lambda last: hour <= last, F.lit(None).cast("string"))


def customer_tier(spend: Column) -> Column:
    return _bands(fixed.CUSTOMER_TIERS, lambda least: spend >= least, F.lit(fixed.BASE_CUSTOMER_TIER))


def risk_tier(score: Column) -> Column:
    return _bands(fixed.RISK_TIERS, lambda least: score >= F.lit(least), F.lit(fixed.BASE_RISK_TIER))
