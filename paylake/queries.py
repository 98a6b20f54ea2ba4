"""The registered queries: every table and operator over the given data."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paylake import adapter
from paylake.config import Run, Settings, SkewPolicy
from paylake.fixed import CANONICAL_COLUMNS, SIGNAL_TYPES, TRACKED_CUSTOMER_COLUMNS
from paylake.functions import numbers, text
from paylake.functions.audit import AUDIT_COLUMNS
from paylake.operators import pages as paging, versions
from paylake.operators.scratch import file_system, new_path, stored
from paylake.operators.timeline import COUNTS
from paylake.operators.upsert import upsert
from paylake.plans import customers, enriched, fraud, history, staging, transactions, velocity
from paylake.quality.evaluate import evaluate
from paylake.quality.freshness import freshness
from paylake.sources import landing, ledger, manifest, pages, raw as raw_table, statements

Query = Callable[[SparkSession, str], DataFrame]

RUN = Run(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1), "registered-query")
# The plans for hot keys, on any data: a key is hot from 300 rows on.
HOT_RUN = dataclasses.replace(RUN, settings=Settings(skew=SkewPolicy(min_rows=300, max_keys=1000)))
FIRST_SLICE = dt.date(2024, 1, 15)
SNAPSHOT_DAYS = (dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 1, 31))
RANGE_DAYS = tuple(dt.date(2024, 1, d) for d in range(1, 31))
PAGE_ORDER = ("txn_timestamp", "txn_id")
FEED_DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))


def shown(df: DataFrame) -> DataFrame:
    """Result as compared: no run stamps, decimals as double, dates and lists as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        columns.append(c.alias(f.name))
    return df.select(*columns).drop("_processed_ts", *AUDIT_COLUMNS)


# -- shared inputs -----------------------------------------------------------------------


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    """Staging as part of the query's own plan, for plans that read it once."""
    return staging.stage(adapter.raw_transactions(spark, sf), RUN)


def _staged_table(spark: SparkSession, sf: str) -> DataFrame:
    """Staging written out, for plans that read it several times."""
    return stored(_staged(spark, sf), "stg")


def _hot(spark: SparkSession, sf: str) -> DataFrame | None:
    """Hot senders, counted on raw rows: one narrow column instead of the deduplicated table."""
    return enriched.hot_senders(adapter.raw_transactions(spark, sf), RUN, staging.sender_vpa())


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return enriched.with_flags(_staged(spark, sf))


def _flagged_table(spark: SparkSession, sf: str) -> DataFrame:
    return enriched.with_flags(_staged_table(spark, sf))


def _staged_and_hot(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame | None]:
    """Staging and hot senders; the plan for hot senders reads staging twice, so it gets a table."""
    hot = _hot(spark, sf)
    return (_staged(spark, sf) if hot is None else _staged_table(spark, sf)), hot


def _features(spark: SparkSession, sf: str) -> DataFrame:
    stg, hot = _staged_and_hot(spark, sf)
    return enriched.features(stg, RUN, hot)


def _signals(spark: SparkSession, sf: str, only: str | None = None) -> DataFrame:
    return fraud.fct_fraud_signals(_features(spark, sf), RUN, only)


def _history(flagged: DataFrame) -> DataFrame:
    """Customer versions after a snapshot on each of the three days."""
    spark = flagged.sparkSession
    path = new_path(spark, "snp_customers")
    for day in SNAPSHOT_DAYS:
        now = customers.customers_current(flagged.where(F.col("txn_date") <= F.lit(day)))
        versions.snapshot(now, path, "sender_vpa", TRACKED_CUSTOMER_COLUMNS, dt.datetime.combine(day, dt.time()))
    return versions.read_versions(spark, path)


# -- landing and raw ---------------------------------------------------------------------


def raw_load_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return shown(raw_table.accepted(adapter.landing_rows(spark, sf)))


def raw_load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return shown(raw_table.rejects(adapter.landing_rows(spark, sf)))


def _days(df: DataFrame, column: str) -> list[dt.date]:
    return [r[0] for r in df.select(column).distinct().collect()]


def raw_reload_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Load every date, load the last one again, count what the raw table holds."""
    rows = stored(adapter.landing_rows(spark, sf), "landing")
    days = sorted(_days(rows, "date"))
    raw = new_path(spark, "raw")
    raw_table.load(rows, raw, days)
    raw_table.load(rows, raw, days[-1:])
    counts = raw_table.read_raw(spark, raw).groupBy("_source_date", "_source").agg(F.count("*").alias("loaded_rows"))
    return shown(counts)


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored(adapter.raw_transactions(spark, sf).withColumnsRenamed({"_source_date": "date"}), "raw")
    root = new_path(spark, "landing")
    days = _days(rows, "date")
    for source in ("csv", "api"):
        landing.land_dates(rows.where(F.col("_source") == source), root, source, days)
    return landing.read_landing(spark, root)


def _delivered(spark: SparkSession, sf: str) -> str:
    """Statements and pages of every date, some with columns of other names, landed in one go for all dates.

    On the 13th statements lack ``amount`` and have ``amount_inr``; on the 20th records have a ``channel``.
    Amounts of reversed records of the feed are no numbers.
    """
    rows = stored(adapter.raw_transactions(spark, sf), "raw").withColumn("amount", F.col("amount").cast("string"))
    days = sorted(_days(rows, "_source_date"))
    statement_folder, feed, root = (new_path(spark, n) for n in ("statements", "feed", "landing"))
    named = rows.where("_source = 'csv'").withColumn("file", F.concat(F.lit("bank_"), F.col("_source_date").cast("string"), F.lit(".csv")))
    odd = F.dayofmonth("_source_date") == 13
    for part, amount in ((~odd, "amount"), (odd, "amount_inr")):
        named.where(part).hint("rebalance", "file").select(*[F.col(c).alias(amount if c == "amount" else c) for c in CANONICAL_COLUMNS if c != "ingested_at"], "file").write.mode("append") \
            .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).partitionBy("file").csv(statement_folder)

    api = rows.where("_source = 'api'").withColumn("amount", F.when(F.col("status") == "REVERSED", "reversed").otherwise(F.col("amount")))
    record = [F.col(c).cast("string").alias(c) for c in CANONICAL_COLUMNS]
    for day_20, names in ((False, record), (True, [*record, F.lit("app").alias("channel")])):
        some = api.where((F.dayofmonth("_source_date") == 20) == day_20)
        page = F.struct(F.col("_source_date"), F.pmod(F.xxhash64("txn_id", "remarks"), F.lit(3)).alias("page"))
        envelopes = some.select(page.alias("p"), F.struct(*names).alias("r")).groupBy("p").agg(F.collect_list("r").alias("records"), F.count("*").alias("count"))
        totals = some.groupBy("_source_date").agg(F.count("*").alias("total"))
        envelopes.select("p.*", "records", "count").join(totals, "_source_date").hint("rebalance", "_source_date").write.mode("append").option("ignoreNullFields", False).partitionBy("_source_date").json(feed)
    for day in days:  # the feed has a folder for each date
        _renamed(spark, f"{feed}/_source_date={day}", f"{feed}/{day}")
    statements.land_statements(spark, statement_folder, root, RUN, days)
    pages.land_feed(spark, feed, root, RUN, dates=days)
    return root


def _renamed(spark: SparkSession, path: str, to: str) -> None:
    fs, where = file_system(spark, path)
    fs.rename(where, file_system(spark, to)[1])


def landing_manifest(spark: SparkSession, sf: str) -> DataFrame:
    root = _delivered(spark, sf)
    return shown(manifest.manifest(landing.read_landing(spark, root), ledger.read_ledger(spark, root)))


def arrival_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Missing and extra columns of the files of every source and date."""
    rows = ledger.read_ledger(spark, _delivered(spark, sf))
    return shown(rows.select("date", "source", "missing", "extra").distinct())


def origin_from_path(spark: SparkSession, sf: str) -> DataFrame:
    origin = landing.origin_from_path(F.col("_metadata.file_path"))
    return _landed(spark, sf).select(origin.alias("origin")).groupBy("origin").agg(F.count("*").alias("row_count"))


def csv_alias_union_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Statement files in two header layouts, written from the raw rows, then read back and landed."""
    rows = adapter.raw_transactions(spark, sf).withColumn("amount", F.col("amount").cast("string"))
    folder = new_path(spark, "statements")
    alias = {"txn_id": " Transaction_ID", "sender_vpa": "from_vpa", "amount": "txn_amount", "txn_timestamp": "timestamp", "ip_address": "IP"}
    order = [F.col(c).asc_nulls_last() for c in ("txn_timestamp", "txn_id", "remarks")]
    for source, names in (("csv", {}), ("api", alias)):
        part = rows.where(F.col("_source") == source).repartitionByRange(*order).sortWithinPartitions(*order)
        part = part.select(*[F.col(c).alias(names.get(c, c)) for c in CANONICAL_COLUMNS])
        name = f"bank_statement_{RUN.run_date}_{'a' if source == 'csv' else 'b'}.csv"
        part.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/{name}")
    return shown(landing.coerced(statements.read_statements(spark, folder, RUN)))


def statements_accounted(spark: SparkSession, sf: str) -> DataFrame:
    """A statement with amounts under two names, day-first and unreadable times, unreadable amounts
    and lines that are too long: every line lands or is rejected with its reason."""
    e, ts = F.col("event_id"), F.col("ts")
    amount = F.when(e % 41 == 3, "x").otherwise((e % 1000).cast("string"))
    time = F.when(e % 50 == 7, "soon").when(e % 3 == 0, F.date_format(ts, "dd/MM/yyyy HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    lines = adapter.events(spark, sf).select(
        F.concat(F.lit("T"), e.cast("string")).alias("txn_id"), F.when(e % 2 == 0, amount).alias("amount"), F.when(e % 2 == 1, amount).alias("txn_amount"),
        time.alias("timestamp"), F.when(e % 37 == 5, "a@x,more").otherwise("a@x").alias("from_vpa"))
    folder, root = new_path(spark, "statements"), new_path(spark, "landing")
    lines.write.options(header=True, quote="\u0000").csv(f"{folder}/bank_{RUN.run_date}.csv")
    statements.land_statements(spark, folder, root, RUN)
    arrived = landing.read_landing(spark, root, [RUN.run_date])
    landed, rejected = landing.landed(arrived), landing.rejected(arrived)
    kept = ["txn_id", F.col("amount").cast("double").cast("bigint").cast("string").alias("amount"), "txn_timestamp", F.lit(None).cast("string").alias("reject_reason")]
    return landed.select(*kept).union(rejected.select("txn_id", "amount", "txn_timestamp", "reject_reason"))


def paged_text_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages with their amounts as text."""
    return paged_source_read(spark, sf, "string")


def paged_source_read(spark: SparkSession, sf: str, amounts: str = "double") -> DataFrame:
    """Page envelopes of at most 200 records, written from the raw rows, then read back and landed."""
    rows = adapter.raw_transactions(spark, sf).where(F.col("_source") == "api")
    record = F.struct(*[F.col(c).cast(amounts if c == "amount" else "string").alias(c) for c in CANONICAL_COLUMNS])
    page = rows.select(record.alias("r"), F.monotonically_increasing_id().alias("i")).withColumn("page", F.expr("i div 200"))
    path = new_path(spark, "pages")
    page.groupBy("page").agg(F.collect_list("r").alias("records"), F.count("*").alias("count")).select(
        "records", F.lit(rows.count()).alias("total"), "count",
        ((F.col("page") + 1) * 200).cast("string").alias("next_cursor"), "page",
    ).write.json(path)
    return shown(landing.coerced(pages.read_feed(spark, path, *FEED_DAYS)))


# -- tables ------------------------------------------------------------------------------


def stg_incremental_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Staging loaded in two slices, the second from the high-water mark of the first."""
    raw = adapter.raw_transactions(spark, sf)
    path = new_path(spark, "stg")
    upsert(staging.stage(raw.where(F.col("_source_date") <= F.lit(FIRST_SLICE)), RUN), path, "txn_id", "txn_date")
    high_water = spark.read.parquet(path).agg(F.max("txn_date")).first()[0]
    upsert(staging.stage(staging.new_rows(raw, high_water), RUN), path, "txn_id", "txn_date")
    return shown(spark.read.parquet(path))


def _pages(spark: SparkSession, sf: str) -> paging.PageDirectory:
    return paging.PageDirectory.build(_staged(spark, sf), PAGE_ORDER)


def _range_history(flagged: DataFrame) -> DataFrame:
    """Customer versions after a snapshot on every day of the month, all from one job chain."""
    spark = flagged.sparkSession
    path = new_path(spark, "snp_customers")
    history.snapshot_range(flagged, path, [(d, dt.datetime.combine(d, dt.time())) for d in RANGE_DAYS])
    return versions.read_versions(spark, path)


def fct_transactions_as_of(spark: SparkSession, sf: str, run: Run = RUN) -> DataFrame:
    """Each transaction with the tier and lifetime figures its sender had then."""
    flagged = _flagged_table(spark, sf)
    dim = customers.dim_customers(_range_history(flagged))
    return shown(transactions.fct_transactions_as_of(flagged, dim, enriched.hot_senders(flagged, run)))


def sender_velocity(spark: SparkSession, sf: str) -> DataFrame:
    return velocity.sender_velocity(_flagged_table(spark, sf)).select(
        "txn_id", "sender_vpa", "txn_timestamp", "sender_5min_txns", F.col("sender_5min_amount_inr").cast("double"), "is_new_payee", "is_new_city")


def velocity_signals(spark: SparkSession, sf: str) -> DataFrame:
    settings = Settings(burst_min_txns=2)
    return shown(velocity.velocity_signals(velocity.sender_velocity(_flagged_table(spark, sf)), dataclasses.replace(RUN, settings=settings)))


def fct_transactions(spark: SparkSession, sf: str, all_versions: bool = False) -> DataFrame:
    stg = _staged_table(spark, sf)
    hot = enriched.hot_senders(stg, RUN)
    dim = customers.dim_customers(_history(enriched.with_flags(stg)))
    return shown(transactions.fct_transactions(enriched.enrich(stg, RUN, hot), dim, all_versions))


def fct_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    return shown(transactions.fct_daily_summary(_flagged_table(spark, sf)))


def int_transactions_enriched_hot(spark: SparkSession, sf: str) -> DataFrame:
    stg = _staged_table(spark, sf)
    return shown(enriched.features(stg, HOT_RUN, enriched.hot_senders(stg, HOT_RUN)).drop(*COUNTS))


def fct_daily_summary_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The same figures when every group of more than two rows takes the plan for large groups."""
    return shown(transactions.fct_daily_summary(_flagged_table(spark, sf), bound=2))


def fct_fraud_summary(spark: SparkSession, sf: str) -> DataFrame:
    stg = _staged_table(spark, sf)
    signals = fraud.fct_fraud_signals(enriched.features(stg, RUN, enriched.hot_senders(stg, RUN)), RUN)
    return shown(fraud.fct_fraud_summary(signals, stg))


def dq_results(spark: SparkSession, sf: str) -> DataFrame:
    raw = adapter.raw_transactions(spark, sf)
    stg = _staged_table(spark, sf)
    features = stored(enriched.features(stg, RUN, enriched.hot_senders(stg, RUN)), "features")
    dim = stored(customers.dim_customers(versions.first_versions(customers.customers_current(features), "sender_vpa", RUN.run_ts)), "dim")
    signals = stored(fraud.fct_fraud_signals(features, RUN), "signals")
    return evaluate({
        "raw_upi_transactions": raw,
        "stg_upi_transactions": stg,
        "fct_transactions": transactions.fct_transactions(features, dim),
        "fct_daily_summary": transactions.fct_daily_summary(features),
        "dim_customers": dim.where("is_current"),
        "fct_customer_activity": transactions.fct_customer_activity(features),
        "fct_fraud_signals": signals,
        "fct_fraud_summary": fraud.fct_fraud_summary(signals, stg),
    }, RUN)


def paisa_to_inr(spark: SparkSession, sf: str) -> DataFrame:
    paisa = (F.col("value").cast("decimal(12,2)") * 100).cast("bigint")
    rows = adapter.events(spark, sf).select("event_id", paisa.alias("paisa"))
    return shown(rows.withColumn("amount_inr", numbers.paisa_to_inr(F.col("paisa"))))


def vpa_validity_by_bank(spark: SparkSession, sf: str) -> DataFrame:
    valid = text.is_valid_vpa(F.col("sender_vpa"))
    return adapter.raw_transactions(spark, sf).groupBy(text.bank_handle(F.col("sender_vpa")).alias("bank")).agg(
        F.count_if(valid).alias("valid_vpas"), F.count_if(~valid).alias("invalid_vpas"))


def _one_rule(name: str) -> Query:
    return lambda spark, sf: shown(_signals(spark, sf, name))


def queries() -> dict[str, Query]:
    return {
        "raw_adapter": lambda s, d: shown(adapter.raw_transactions(s, d)),
        "raw_load_accepted": raw_load_accepted,
        "raw_load_rejects": raw_load_rejects,
        "raw_reload_counts": raw_reload_counts,
        "stg_upi_transactions": lambda s, d: shown(_staged(s, d)),
        "stg_incremental_upsert": stg_incremental_upsert,
        "int_transactions_enriched": lambda s, d: shown(_features(s, d).drop(*COUNTS)),
        "int_transactions_enriched_hot": int_transactions_enriched_hot,
        "fct_daily_summary_hot": fct_daily_summary_hot,
        "home_city_mode": lambda s, d: customers.sender_modes(_staged(s, d)).where("home_city is not null").drop("primary_device_type"),
        "primary_device_mode": lambda s, d: customers.sender_modes(_staged(s, d)).drop("home_city"),
        "int_customers_current": lambda s, d: shown(customers.customers_current(_flagged_table(s, d))),
        "snp_customers": lambda s, d: shown(_history(_flagged_table(s, d))),
        "dim_customers": lambda s, d: shown(customers.dim_customers(_history(_flagged_table(s, d)))),
        "fct_transactions": fct_transactions,
        "fct_transactions_all_versions": lambda s, d: fct_transactions(s, d, all_versions=True),
        "fct_daily_summary": fct_daily_summary,
        "snp_customers_range": lambda s, d: shown(_range_history(_flagged_table(s, d))),
        "fct_transactions_as_of": fct_transactions_as_of,
        "fct_transactions_as_of_hot": lambda s, d: fct_transactions_as_of(s, d, HOT_RUN),
        "sender_velocity": sender_velocity,
        "velocity_signals": velocity_signals,
        "fct_customer_activity": lambda s, d: shown(transactions.fct_customer_activity(_flagged(s, d))),
        "fct_fraud_signals": lambda s, d: shown(_signals(s, d)),
        **{f"signal_{name.lower()}": _one_rule(name) for name in SIGNAL_TYPES},
        "fct_fraud_scores": lambda s, d: shown(fraud.fct_fraud_scores(_signals(s, d))),
        "fct_fraud_summary": fct_fraud_summary,
        "csv_alias_union_dedup": csv_alias_union_dedup,
        "paged_source_read": paged_source_read,
        "paged_text_amounts": paged_text_amounts,
        "statements_accounted": statements_accounted,
        "txn_lookup": lambda s, d: shown(pages.lookup(adapter.raw_transactions(s, d), "TXN100")),
        "txn_page": lambda s, d: shown(_pages(s, d).page(400, 200)),
        "txn_page_far": lambda s, d: shown(_pages(s, d).page(700, 500)),
        "txn_page_after": lambda s, d: shown(paging.page_after(_staged(s, d), PAGE_ORDER, (dt.datetime(2024, 1, 15), ""), 200)),
        "origin_from_path": origin_from_path,
        "landing_manifest": landing_manifest,
        "arrival_ledger": arrival_ledger,
        "dq_results": dq_results,
        "source_freshness": lambda s, d: freshness(adapter.raw_transactions(s, d), RUN),
        "paisa_to_inr": paisa_to_inr,
        "vpa_validity_by_bank": vpa_validity_by_bank,
    }
