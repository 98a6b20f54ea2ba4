"""As-of join: each row with the last row of the other side, by key, at or before its time.

Both sides are put one under the other and the last value in (key, time) order is carried on, so
there is no range join and no product: one shuffle and one sort by key and time. A hot key's rows are
cut into slices of time, and each slice begins with the value that held before it. The right side has
to be small for each key (versions of a customer), the left one does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.operators.skew import flag_hot


def _carried(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Rows of ``left`` with ``_value``; both have ``by`` and ``_time``, the right one ``_value``."""
    value = next(f.dataType for f in right.schema.fields if f.name == "_value")
    both = left.select(*left.columns, F.lit(None).cast(value).alias("_value"), F.lit(1).alias("_side")).unionByName(
        right.select(*by, "_time", "_value").withColumn("_side", F.lit(0)), allowMissingColumns=True)
    # The right side comes first at equal times: a version holds from its start on.
    so_far = Window.partitionBy(*by).orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).where("_side = 1").drop("_side")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, into: str, hot: DataFrame | None = None) -> DataFrame:
    """``left`` with ``into``, a struct of the right row's other columns that holds at ``left_time``, or null.

    Keys are equal columns of one name; a null key or time meets nothing. Right rows of one key should
    have different times; of equal ones either may be taken. ``hot``: keys that are cut by day.
    """
    payload = F.struct(*[F.col(c) for c in right.columns if c != key])
    values = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        key, F.col(right_time).alias("_time"), payload.alias("_value"))
    known = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    rows = left.withColumn("_time", F.col(left_time))
    nothing = rows.where(~known).withColumn("_value", F.lit(None).cast(values.schema["_value"].dataType))
    rows = rows.where(known)
    if hot is None:
        found = _carried(rows, values, [key])
    else:
        by = [key, "_slice"]
        names = hot.select(F.col(hot.columns[0]).alias(key))
        rows = _sliced(flag_hot(rows, names, "_hot"))
        cut = _sliced(flag_hot(values, names, "_hot"))
        # The value that holds at the start of a slice; one row for each hot key and day that occurs.
        starts = rows.where("_hot").select(key, "_slice").distinct().withColumn("_time", F.col("_slice").cast(left.schema[left_time].dataType))
        before = _carried(starts, values.join(F.broadcast(names), key, "left_semi"), [key]).where("_value is not null")
        # A version that begins at that very instant is carried on already; the same value twice does no harm.
        found = _carried(rows.drop("_hot"), cut.select(*by, "_time", "_value").unionByName(before.select(*by, "_time", "_value")), by).drop("_slice")
    return found.unionByName(nothing).withColumnRenamed("_value", into).drop("_time")


def _sliced(rows: DataFrame) -> DataFrame:
    day: Column = F.when(F.col("_hot"), F.to_date("_time"))
    return rows.withColumn("_slice", day)
