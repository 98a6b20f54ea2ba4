"""The daily run, end to end, for one date or a range of dates.

    python -m paylake.daily --root DIR --statements DIR --feed DIR --date 2024-01-05 [--to 2024-01-09]
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.config import Run
from paylake.fixed import TRACKED_CUSTOMER_COLUMNS
from paylake.functions.audit import AUDIT_COLUMNS, with_audit
from paylake.operators import versions
from paylake.operators.scratch import stored_for
from paylake.operators.timeline import COUNTS
from paylake.operators.upsert import upsert
from paylake.plans import continued, customers, enriched, fraud, staging, transactions
from paylake.quality.evaluate import enforce, evaluate
from paylake.sources import manifest, raw as raw_table
from paylake.sources.landing import read_landing
from paylake.sources.pages import land_feed
from paylake.sources.statements import land_statements
from paylake.tables import Tables
from paylake.touched import Touched

STAGES = ("ingest", "load", "prep", "snapshot", "marts", "quality")
SESSION = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": SparkConf().get("spark.ui.enabled", "false")}
MARTS = ("fct_transactions", "fct_daily_summary", "fct_customer_activity", "fct_fraud_signals", "fct_fraud_scores", "fct_fraud_summary")


@dataclass(frozen=True)
class Inputs:
    """Folder of statement files, and folder with one folder of pages per date.

    ``whole_pages``: a page envelope is a whole file, not a line.
    """

    statements: str
    feed: str
    whole_pages: bool = False


def ingest(tables: Tables, inputs: Inputs) -> dict:
    """Land both sources of the run date; raises if something is missing."""
    spark, run, landing = tables.spark, tables.run, f"{tables.root}/landing"
    land_statements(spark, inputs.statements, landing, run)
    land_feed(spark, inputs.feed, landing, run, inputs.whole_pages)
    return manifest.save_manifest(spark, landing, f"{tables.root}/manifest", run.run_date)


def load(tables: Tables) -> int:
    """Replace the run date in the raw table with what landed."""
    day = tables.run.run_date
    arrived = read_landing(tables.spark, f"{tables.root}/landing", [day])
    return raw_table.load(arrived, tables.path("raw_upi_transactions"), [day])[str(day)]


def build_staging(tables: Tables, full_refresh: bool = False) -> None:
    """Merge new raw rows into staging.

    Only source dates from the newest staged day on are read, so a date that arrives out
    of order is left out until a ``full_refresh``.
    """
    raw = tables.read("raw_upi_transactions")
    run, table, touched = tables.run, "stg_upi_transactions", Touched(tables.spark, tables.root)
    if full_refresh or not tables.exists(table):
        touched.note(MARTS, None)
        tables.replace(staging.stage(raw, run), table, "txn_date")
        return
    high_water = tables.read(table).agg(F.max("txn_date")).first()[0]
    rows = staging.stage(staging.new_rows(raw, high_water), run)
    upsert(with_audit(rows, run, table), tables.folder(table), "txn_id", "txn_date", note=lambda days: touched.note(MARTS, days))


def _staged(tables: Tables) -> DataFrame:
    return tables.read("stg_upi_transactions").drop(*AUDIT_COLUMNS)


def build_customers(tables: Tables) -> None:
    tables.replace(customers.customers_current(enriched.with_flags(_staged(tables))), "int_customers_current")


def take_snapshot(tables: Tables) -> None:
    versions.snapshot(
        tables.read("int_customers_current"), tables.path("snp_customers"),
        "sender_vpa", TRACKED_CUSTOMER_COLUMNS, tables.run.run_ts.replace(microsecond=0))


def dim_customers(tables: Tables) -> DataFrame:
    """The customer dimension, a view over the history."""
    return customers.dim_customers(versions.read_versions(tables.spark, tables.path("snp_customers")))


def _day_local(tables: Tables, stg: DataFrame, features: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """The marts of which a day follows from its own transactions alone."""
    def signals() -> DataFrame:
        return fraud.fct_fraud_signals(features, tables.run)

    def scores() -> DataFrame:
        return fraud.fct_fraud_scores(signals()).withColumn("txn_date", F.to_date("txn_timestamp"))

    return {
        "fct_daily_summary": lambda: transactions.fct_daily_summary(features),
        "fct_customer_activity": lambda: transactions.fct_customer_activity(features),
        "fct_fraud_signals": signals,
        "fct_fraud_scores": scores,
        "fct_fraud_summary": lambda: fraud.fct_fraud_summary(signals(), stg),
    }


def _versions_shown(tables: Tables) -> DataFrame:
    open_rows = versions.read_versions(tables.spark, tables.path("snp_customers")).where("dbt_valid_to is null")
    return open_rows.select("sender_vpa", "dbt_scd_id")


def _build_whole(tables: Tables, only: list[str]) -> None:
    """Marts from all of staging. Enriched rows are written once and read by all of them."""
    run, stg = tables.run, _staged(tables)
    with stored_for(enriched.features(stg, run, enriched.hot_senders(stg, run)), "enriched") as rows:
        for mart, build in _day_local(tables, stg, rows).items():
            if mart in only:
                tables.replace(build(), mart, "txn_date")
        if "fct_transactions" in only:
            shown = _versions_shown(tables)
            tables.replace(transactions.fct_transactions(rows.drop(*COUNTS), dim_customers(tables)), "fct_transactions", "txn_date")
            tables.replace(continued.counts_by_day(rows), "sender_days", "txn_date")
            tables.replace(shown, "fact_versions")


def _build_days(tables: Tables, only: dict[str, tuple[dt.date, ...]]) -> None:
    """Marts of touched days, by mart. Ranks go on from the stored counts of senders by day."""
    run, stg = tables.run, _staged(tables)
    local = {m: d for m, d in only.items() if m != "fct_transactions" and d}
    if local:
        days = sorted({d for some in local.values() for d in some})
        part = stg.where(F.col("txn_date").isin(days))
        with stored_for(enriched.features(part, run, enriched.hot_senders(part, run)), "enriched") as rows:
            for mart, build in _day_local(tables, part, rows).items():
                if mart in local:
                    tables.replace_days(build(), mart, "txn_date", local[mart])
    if "fct_transactions" in only:
        touched, before = list(only["fct_transactions"]), tables.read("sender_days").select("sender_vpa", "txn_date", "n")
        fresh = continued.counts_by_day(stg.where(F.col("txn_date").isin(touched)))
        with stored_for(before.where(~F.col("txn_date").isin(touched)).unionByName(fresh), "counts") as now, \
                stored_for(_versions_shown(tables), "versions") as shown:
            days = continued.days_to_build(touched, before, now, tables.read("fact_versions"), shown)
            if days:
                rows = continued.enriched_of_days(stg, now, days, run)
                tables.replace_days(transactions.fct_transactions(rows, dim_customers(tables)), "fct_transactions", "txn_date", days)
            # What the facts go on from changes after them: a run that stops here builds the same days again.
            if touched:
                tables.replace_days(now, "sender_days", "txn_date", touched)
            tables.replace(shown, "fact_versions")


def build_marts(tables: Tables, only: Iterable[str] = MARTS) -> dict[str, tuple[dt.date, ...] | None]:
    """Bring the chosen marts up to staging; returns the touched days of each, None for all.

    A mart that exists and knows all days that changed since it was built gets these days alone.
    """
    touched, chosen = Touched(tables.spark, tables.root), [m for m in MARTS if m in set(only)]
    notes = {m: touched.open_notes(m) for m in chosen}
    kept = {m: [m, "sender_days", "fact_versions"] if m == "fct_transactions" else [m] for m in chosen}
    whole = [m for m in chosen if notes[m].days is None or not all(map(tables.exists, kept[m]))]
    if whole:
        _build_whole(tables, whole)
    _build_days(tables, {m: notes[m].days for m in chosen if m not in whole})
    for m in chosen:
        touched.done(m, notes[m])
    return {m: None if m in whole else notes[m].days for m in chosen}


def check_quality(tables: Tables) -> DataFrame:
    """Evaluate every rule on the stored tables and keep the counts per run date."""
    relations = {t: tables.read(t) for t in ("raw_upi_transactions", "stg_upi_transactions", *MARTS)}
    relations["dim_customers"] = dim_customers(tables).where("is_current")
    path = f"{tables.path('dq_results')}/run_date={tables.run.run_date}"
    evaluate(relations, tables.run).coalesce(1).write.mode("overwrite").parquet(path)
    return tables.spark.read.parquet(path)


def write_metrics(tables: Tables, loaded: int | None) -> dict[str, int]:
    """Row counts of the run, from file footers, so task retries cannot distort them."""
    counts = {"loaded_rows": loaded} if loaded is not None else {}
    for table in ("raw_upi_transactions", "raw_rejects", "stg_upi_transactions", "int_customers_current", "snp_customers", *MARTS):
        if tables.exists(table):
            counts[table] = tables.read(table).count()
    rows = tables.spark.createDataFrame(list(counts.items()), "metric string, row_count bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{tables.path('run_metrics')}/run_date={tables.run.run_date}")
    return counts


def run_date(
    spark: SparkSession, root: str, inputs: Inputs, run: Run,
    stages: Iterable[str] = STAGES, marts: Iterable[str] = MARTS, full_refresh: bool = False, strict: bool = False,
) -> dict[str, int]:
    """One run. ``stages`` and ``marts`` choose a subset; ``strict`` fails on broken rules."""
    tables, chosen, loaded = Tables(spark, root, run), set(stages), None
    if unknown := (chosen - set(STAGES)) | (set(marts) - set(MARTS)):
        raise ValueError(f"unknown stages or marts: {sorted(unknown)}")
    if "ingest" in chosen:
        ingest(tables, inputs)
    if "load" in chosen:
        loaded = load(tables)
    if "prep" in chosen:
        build_staging(tables, full_refresh)
        build_customers(tables)
    if "snapshot" in chosen:
        take_snapshot(tables)
    if "marts" in chosen:
        build_marts(tables, marts)
    if "quality" in chosen:
        results = check_quality(tables)
        if strict:
            enforce(results)
    return write_metrics(tables, loaded)


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_range(
    spark: SparkSession, root: str, inputs: Inputs, first: Run, last: dt.date, clock: Callable[[], dt.datetime] = now, **kw,
) -> dict[str, dict[str, int]]:
    """One run per date in order; history and high-water mark depend on that order.

    The first run has the time of ``first``, every later one the time at which it starts, so no
    stamp lies in the future. The history counts in seconds: each run starts a second after the
    one before at least.
    """
    results, day, at = {}, first.run_date, first.run_ts
    while day <= last:
        results[str(day)] = run_date(spark, root, inputs, replace(first, run_date=day, run_ts=at), **kw)
        day, at = day + dt.timedelta(days=1), max(clock(), at + dt.timedelta(seconds=1))
    return results


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Daily transaction run")
    p.add_argument("--root", required=True)
    p.add_argument("--statements", required=True)
    p.add_argument("--feed", required=True)
    p.add_argument("--date", type=dt.date.fromisoformat, required=True)
    p.add_argument("--to", type=dt.date.fromisoformat)
    p.add_argument("--target", default="dev")
    p.add_argument("--stages", nargs="+", default=STAGES, choices=STAGES)
    p.add_argument("--marts", nargs="+", default=MARTS, choices=MARTS)
    p.add_argument("--whole-pages", action="store_true", help="a page of the feed is a whole file, not a line")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--strict", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("paylake-daily").config(map=SESSION).getOrCreate()
    done = run_range(spark, a.root, Inputs(a.statements, a.feed, a.whole_pages), Run.for_date(a.date, target=a.target), a.to or a.date,
                     stages=a.stages, marts=a.marts, full_refresh=a.full_refresh, strict=a.strict)
    for day, counts in done.items():
        print(day, counts)


if __name__ == "__main__":
    main()
