"""Paged feed delivered as JSON files, one page envelope per line or file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paylake.config import Run
from paylake.fixed import CANONICAL_COLUMNS
from paylake.operators.scratch import stored
from paylake.sources.landing import land_dates
from paylake.sources.ledger import record

_CORRUPT = "_unreadable"
# Records are maps, so their names are known from the one parse: what a page lacks or has besides.
PAGE = T.StructType([
    T.StructField("records", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("total", T.LongType()),
    T.StructField("count", T.LongType()),
    T.StructField("next_cursor", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField(_CORRUPT, T.StringType()),
])


class IncompletePull(RuntimeError):
    """Fewer records arrived than the feed announced, or pages that cannot be read."""


def read_pages(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Page envelopes, one per line or, with ``multi_line``, one per file; read in parallel.

    Values are kept as text, whether they came as numbers or as text. The pages are written once as
    Parquet, so that checks, profiles and records do not parse them again.
    """
    found = spark.read.schema(PAGE).options(multiLine=multi_line, columnNameOfCorruptRecord=_CORRUPT).json(path)
    names = F.array_distinct(F.flatten(F.transform("records", lambda r: F.map_keys(r))))
    return stored(found.select(
        F.col("_metadata.file_path").alias("file"), "total", (F.col(_CORRUPT).isNotNull() | F.col("records").isNull()).alias("bad"),
        F.coalesce(F.size("records"), F.lit(0)).alias("n"), names.alias("names"), "records"), "pages")


def check_complete(pages: DataFrame, date: Column | None = None) -> int:
    """Raise unless all pages can be read and the records of each date add up to its announced total."""
    n = F.greatest(F.col("n"), F.lit(0))
    day = F.lit(None).cast("string") if date is None else date.cast("string")
    found = pages.groupBy(day.alias("date")).agg(F.sum(n).alias("got"), F.max("total").alias("announced"), F.count_if("bad").alias("bad")).collect()
    if not found:
        raise IncompletePull("no page announces a total")
    for day, got, announced, unreadable in sorted(found, key=lambda r: r[0] or ""):
        of = f" of {day}" if day else ""
        if unreadable:
            raise IncompletePull(f"{unreadable} pages or lines{of} are no page envelopes; whole-file envelopes need multi_line")
        if announced is None:
            raise IncompletePull(f"no page{of} announces a total")
        if got != announced:
            raise IncompletePull(f"{got} of {announced} records{of} arrived")
    return sum(r["got"] for r in found)


def records(pages: DataFrame, *keep: str) -> DataFrame:
    rows = pages.select(*keep, F.explode("records").alias("r"))
    return rows.select(*[F.try_element_at("r", F.lit(c)).alias(c) for c in CANONICAL_COLUMNS], *keep)


def profiles(pages: DataFrame) -> DataFrame:
    """Names in the records of each file; a file without records tells nothing."""
    each = pages.where("n > 0").select("date", "file", F.explode("names").alias("name")).distinct()
    return each.groupBy("date", "file").agg(F.array_sort(F.collect_set("name")).alias("columns"))


def between_dates(rows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose timestamp text starts with a date in the range, both ends included."""
    return rows.where(F.substring(F.col("txn_timestamp").cast("string"), 1, 10).between(str(first), str(last)))


def lookup(rows: DataFrame, txn_id: str) -> DataFrame:
    return rows.where(F.col("txn_id") == txn_id)


def read_feed(spark: SparkSession, path: str, first: dt.date, last: dt.date, multi_line: bool = False) -> DataFrame:
    pages = read_pages(spark, path, multi_line)
    check_complete(pages)
    return between_dates(records(pages), first, last)


def land_feed(spark: SparkSession, folder: str, root: str, run: Run, multi_line: bool = False, dates: Sequence[dt.date] | None = None) -> None:
    """Land the pages in ``folder/<date>`` for the run date, or for all of ``dates`` at once.

    Every date has to be complete. Records with the time of another day are left out, as the feed
    was asked for one day.
    """
    dates = [run.run_date] if dates is None else list(dates)
    pages = read_pages(spark, [f"{folder}/{d}" for d in dates], multi_line)
    day = F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})/[^/]*$", 1).cast("date")
    pages = pages.withColumn("date", day)
    check_complete(pages, F.col("date"))
    record(profiles(pages), root, "api", dates)
    rows = records(pages, "date")
    land_dates(rows.where(F.substring("txn_timestamp", 1, 10) == F.col("date").cast("string")), root, "api", dates)
