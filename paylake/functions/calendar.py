"""Date and time expressions for timestamps without a zone.

None of them goes through a zoned timestamp, so the session zone has no effect.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def ntz(value: dt.datetime) -> Column:
    """Literal timestamp without a zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_of_week(c: Column) -> Column:
    """0 is Sunday."""
    return (F.dayofweek(c) - 1).cast("bigint")


def second_number(c: Column) -> Column:
    """Whole seconds since 1970-01-01."""
    days = F.datediff(F.to_date(c), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint")


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute marks passed between two instants (not whole minutes elapsed)."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 1440 + (F.hour(end) - F.hour(start)) * 60 + (F.minute(end) - F.minute(start))
