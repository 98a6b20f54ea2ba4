"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_divide(num: Column, den: Column, default: float = 0.0) -> Column:
    """Double division; ``default`` where the denominator is null or zero."""
    empty = den.isNull() | (den == 0)
    return F.when(empty, F.lit(float(default))).otherwise(num.cast("double") / den.cast("double"))


def paisa_to_inr(paisa: Column) -> Column:
    return F.round(paisa.cast("decimal(36,0)") / F.lit(100), 2).cast("decimal(38,2)")


def total(c: Column) -> Column:
    """Sum of amounts."""
    return F.sum(c).cast("decimal(38,2)")


def mean(c: Column) -> Column:
    """Mean from the exact decimal sum, so it does not depend on the order of the rows."""
    return F.sum(c).cast("double") / F.count(c).cast("double")
