"""Type-2 history: a new version of a key whenever a tracked column changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paylake.functions.calendar import ntz
from paylake.operators.partitions import replace_partitions, table_exists
from paylake.operators.scratch import stored_for

OPEN_DAY = dt.date(9999, 12, 31)
CLOSED_ON = "closed_on"


class ClockWentBack(ValueError):
    """A snapshot was asked for an instant before the newest version."""


def opened(states: DataFrame, key: str, at: Column) -> DataFrame:
    """States as open versions; ``at``, their start, as text to the second."""
    return states.withColumns({
        "dbt_scd_id": F.md5(F.concat_ws("|", F.coalesce(key, F.lit("")), at)),
        "dbt_updated_at": at.cast("timestamp_ntz"),
        "dbt_valid_from": at.cast("timestamp_ntz"),
        "dbt_valid_to": F.lit(None).cast("timestamp_ntz"),
    })


def first_versions(current: DataFrame, key: str, at: dt.datetime) -> DataFrame:
    """Every row of ``current`` as an open version that starts at ``at``."""
    return opened(current, key, F.lit(at.strftime("%Y-%m-%d %H:%M:%S")))


def next_versions(open_rows: DataFrame, current: DataFrame, key: str, tracked: Sequence[str], at: dt.datetime) -> DataFrame:
    """Rows that replace ``open_rows``: kept, closed and newly opened ones.

    One full outer join; each joined pair gives one or two rows. Unchanged keys keep their
    stored row as it is, vanished keys stay open.
    """
    names = open_rows.columns
    old = open_rows.select(F.struct(*names).alias("old"))
    new = first_versions(current, key, at).select(F.struct(*names).alias("new"))
    pairs = old.join(new, F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")), "full_outer")

    differs = reduce(lambda a, b: a | b, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = has_old & has_new & differs
    ended = F.col("old").withField("dbt_valid_to", ntz(at))
    rows = F.array_compact(F.array(
        F.when(has_old, F.when(changed, ended).otherwise(F.col("old"))),
        F.when(has_new & (~has_old | changed), F.col("new")),
    ))
    return pairs.select(F.explode(rows).alias("row")).select("row.*")


def read_versions(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(CLOSED_ON)


def snapshot(current: DataFrame, path: str, key: str, tracked: Sequence[str], at: dt.datetime) -> None:
    """Bring the history table at ``path`` up to ``at``.

    The table is partitioned by the day a version ended, open ones in a partition of their
    own: a run rewrites the open partition and adds one for the versions it ends, whatever
    the length of the history. Running again for the same instant changes nothing; an instant
    before the start of the newest version raises ``ClockWentBack``, since versions would end
    before they began.
    """
    spark = current.sparkSession
    ended_on = F.coalesce(F.to_date("dbt_valid_to"), F.lit(OPEN_DAY)).alias(CLOSED_ON)
    if not table_exists(spark, path):
        rows = first_versions(current, key, at)
        rows.select("*", ended_on).write.partitionBy(CLOSED_ON).mode("errorifexists").parquet(path)
        return
    day = at.date()
    table = spark.read.parquet(path)
    is_open = F.col(CLOSED_ON) == OPEN_DAY
    open_rows = table.where(is_open).drop(CLOSED_ON)
    newest = open_rows.agg(F.max("dbt_valid_from")).first()[0]
    if newest is not None and at < newest:
        raise ClockWentBack(f"snapshot at {at}, but a version begins at {newest}")
    # Left behind by a run that stopped between the two writes below: ended, yet still open.
    ended_today = table.where(F.col(CLOSED_ON) == day).drop(CLOSED_ON).join(
        open_rows.select("dbt_scd_id"), "dbt_scd_id", "left_anti").select(open_rows.columns)
    rows = next_versions(open_rows, current, key, tracked, at).unionByName(ended_today)
    with stored_for(rows.select("*", ended_on), "versions") as rows:
        replace_partitions(rows, path, CLOSED_ON, [day])
        replace_partitions(rows, path, CLOSED_ON, [OPEN_DAY])
