"""What landed for a date, and whether the run may go on."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.fixed import SOURCES
from paylake.sources.landing import LANDED, read_landing
from paylake.sources.ledger import drift, read_ledger


class NotReady(RuntimeError):
    """Data is missing or has drifted for the date."""


def row_counts(landing: DataFrame) -> DataFrame:
    """Landed and rejected rows by source and date; a count by folder, no column is read."""
    of = [F.count_if(F.col("verdict") == LANDED).alias("row_count"), F.count_if(F.col("verdict") != LANDED).alias("rejected")]
    return landing.groupBy("source", "date").agg(*of)


def manifest(landing: DataFrame, ledger: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One row per date: rows by source, total, rejected rows, schema drift and readiness.

    Ready means that every source delivered rows and that no file lacks a required column. A date
    of which only rejected rows or only column profiles arrived has a row too.
    """
    total = reduce(lambda a, b: a + b, [F.col(f"{s}_rows") for s in sources])
    everywhere = reduce(lambda a, b: a & b, [F.col(f"{s}_rows") > 0 for s in sources])
    counts = row_counts(landing).groupBy("date").agg(
        *[F.sum(F.when(F.col("source") == s, F.col("row_count"))).alias(f"{s}_rows") for s in sources], F.sum("rejected").alias("rejected_rows"))
    names = [*[f"{s}_rows" for s in sources], "rejected_rows"]
    return counts.join(drift(ledger), "date", "full_outer").withColumns({n: F.coalesce(n, F.lit(0)) for n in names}).select(
        "date", *names[:-1], total.alias("total_rows"), "rejected_rows", F.coalesce("schema_drift", F.lit("")).alias("schema_drift"),
        (everywhere & ~F.coalesce("stops", F.lit(False))).alias("ready"))


def save_manifest(spark: SparkSession, root: str, path: str, date: dt.date) -> dict:
    """Store the manifest of one date and return it; raise if the date is not ready.

    Only the folders of the date are read, so another date's drift does not matter.
    """
    rows = manifest(read_landing(spark, root, [date]), read_ledger(spark, root, [date]))
    rows.coalesce(1).write.mode("overwrite").json(f"{path}/date={date}")
    found = rows.first()
    result = found.asDict() if found else {"date": date, "total_rows": 0, "ready": False}
    if not result["ready"]:
        raise NotReady(f"landing not ready for {date}: {result}")
    return result
