"""Operators against brute force and over repeated runs."""

import datetime as dt
import json
import os
import random
import statistics
import subprocess
import sys
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from paylake.config import Run, Settings, SkewPolicy
from paylake.operators.median import median_by
from paylake.operators.partitions import WRITERS, partition_rows, replace_partitions
from paylake.operators.scratch import shared_dir, stored, stored_for
from paylake.operators.skew import flag_hot, hot_keys
from paylake.operators.timeline import with_sender_timeline
from paylake.operators.upsert import DuplicateKey, upsert
from paylake.operators.versions import read_versions, snapshot
from paylake.plans import customers, fraud, staging, transactions
from paylake.sources import raw as raw_table

RUN = Run(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1), "test")


def test_hot_keys_are_bounded(spark):
    df = spark.createDataFrame([("a",)] * 60 + [(None,)] * 30 + [(str(i),) for i in range(10)], "k string")
    keys = {"k": F.col("k")}
    assert hot_keys(df, keys, SkewPolicy(min_rows=100)) is None
    assert hot_keys(df, keys, SkewPolicy(min_rows=80)) is None
    hot = hot_keys(df, keys, SkewPolicy(min_rows=5, max_keys=4))  # more than a quarter of 100 rows
    assert {r.k for r in hot.collect()} == {"a", None}


@pytest.mark.parametrize("min_rows", [None, 400, 20, 0])
def test_timeline_against_brute_force(spark, min_rows):
    """One sender holds most rows, many of them in the same second; another sender is null."""
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1, 23, 0)
    rows = []
    for i in range(600):
        sender = rng.choices(["hot", None, "x", "y"], [6, 2, 1, 1])[0]
        ts = base + dt.timedelta(seconds=rng.choice([0, 0, 1, 30, 3599, 3600, 3601, 7200, 90000]), microseconds=rng.choice([0, 0, 5]))
        rows.append((f"T{i:04d}", sender, ts, ts.date(), ts.hour, rng.choice(["FAILED", "SUCCESS"])))
    df = spark.createDataFrame(
        rows, "txn_id string, sender_vpa string, txn_timestamp timestamp_ntz, txn_date date, txn_hour bigint, status string")
    hot = None if min_rows is None else hot_keys(df, {"sender_vpa": F.col("sender_vpa")}, SkewPolicy(min_rows, 1000))
    policy = SkewPolicy(min_rows or 0, 1000)
    got = {r.txn_id: tuple(r)[6:] for r in with_sender_timeline(df, hot, policy).select(
        *df.columns, "sender_lifetime_rank", "sender_daily_rank", "sender_hour_txns", "sender_day_txns", "sender_day_failures").collect()}
    want = {}
    for r in rows:
        mine = sorted((q for q in rows if q[1] == r[1]), key=lambda q: (q[2], q[0]))
        day = [q for q in mine if q[3] == r[3]]
        want[r[0]] = (mine.index(r) + 1, day.index(r) + 1, sum(q[4] == r[4] for q in day), len(day), sum(q[5] == "FAILED" for q in day))
    assert got == want


@pytest.mark.parametrize("bound", [0, 150, 10**6])
def test_median_against_brute_force(spark, bound):
    rng = random.Random(3)
    draw = {"a": lambda: rng.randint(-500, 500), None: lambda: rng.choice([1, 10**14, 10**15 - 1]), "b": lambda: rng.randint(0, 10**9)}
    rows = [(k, Decimal(draw[k]()) / 100) for k in ["a"] * 201 + [None] * 100 + ["b"] * 40 + ["a"] * 3]
    df = spark.createDataFrame(rows, "k string, v decimal(15,2)")
    sizes = df.groupBy("k").agg(F.count("*").alias("rows"))
    got = {r.k: r.m for r in median_by(df, ["k"], "v", "m", sizes, bound).collect()}
    want = {k: float(statistics.median(v for q, v in rows if q == k)) for k in draw}
    assert got == pytest.approx(want)


PEAK_OF_A_WRITE = """
import datetime as dt, glob, json, sys
from pyspark.sql import SparkSession, functions as F
from paylake.operators.partitions import replace_partitions
folder = sys.argv[1]
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "8"}).getOrCreate()
days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
rows = spark.range(0, 200_000, 1, 2).select(
    "id", F.date_add(F.lit(days[0]), (F.col("id") % 2).cast("int")).alias("d"), F.when(F.col("id") % 10 < 2, "no").otherwise("yes").alias("v"))
replace_partitions(rows, f"{folder}/t", "d", days, split=("v", ("yes", "no")))
found = spark.read.parquet(f"{folder}/t").groupBy("v").agg(F.count("*"), F.sum("id")).collect()
writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
spark.stop()
ends = [e for f in glob.glob(f"{folder}/local-*") for e in map(json.loads, open(f)) if e["Event"] == "SparkListenerTaskEnd"]
written = [e["Task Metrics"]["Peak Execution Memory"] for e in ends if e["Task Metrics"]["Output Metrics"]["Records Written"]]
print(json.dumps([max(written), sorted(map(list, found)), writers]))
"""


def test_a_write_without_order_does_not_hold_the_rows_of_a_task(tmp_path):
    """The event log of a session of its own has the execution memory of the tasks that write."""
    done = subprocess.run([sys.executable, "-c", PEAK_OF_A_WRITE, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert done.returncode == 0, done.stderr[-2000:]
    peak, found, writers = json.loads(done.stdout.splitlines()[-1])
    sums = {v: [n for n in range(200_000) if (n % 10 < 2) == (v == "no")] for v in ("no", "yes")}
    assert found == [[v, len(n), sum(n)] for v, n in sums.items()] and writers == "0"
    assert peak < 2**20


def test_a_task_with_more_partitions_than_open_files_writes_all_of_them(spark, tmp_path):
    days, path = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(4 * WRITERS)], str(tmp_path / "t")
    rows = [(days[i % len(days)], "no" if i % 3 == 0 else "yes", i) for i in range(10 * len(days))]
    df = spark.createDataFrame(rows, "d date, v string, i int").coalesce(1)
    for _ in range(2):
        replace_partitions(df, path, "d", days, split=("v", ("yes", "no")))
        assert sorted(spark.read.parquet(path).select("d", "v", "i").collect()) == sorted(rows)


def test_replace_partitions_clears_dates_without_rows(spark, tmp_path):
    path, days = str(tmp_path / "t"), [dt.date(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(i, days[i % 3]) for i in range(9)], "v int, d date")
    replace_partitions(df, path, "d", days)
    assert partition_rows(spark.read.parquet(path), "d", days) == {str(d): 3 for d in days}
    replace_partitions(df.where("v = 1"), path, "d", days[:2])
    replace_partitions(df.where("v = 1"), path, "d", days[:1])
    assert partition_rows(spark.read.parquet(path), "d", days) == {"2024-01-01": 0, "2024-01-02": 1, "2024-01-03": 3}
    assert {(r.v, r.d) for r in spark.read.parquet(path).collect()} == {(1, days[1]), (2, days[2]), (5, days[2]), (8, days[2])}


def test_upsert_moves_rows_between_days_and_repeats(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "t"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "k string, v int, d date"
    upsert(spark.createDataFrame([("a", 1, d1), ("b", 1, d2), ("c", 1, d2)], schema), path, "k", "d")
    changes = spark.createDataFrame([("a", 2, d2), ("z", 2, d2)], schema)
    for _ in range(2):
        upsert(changes, path, "k", "d")
        assert {tuple(r) for r in spark.read.parquet(path).select("k", "v", "d").collect()} == {
            ("a", 2, d2), ("b", 1, d2), ("c", 1, d2), ("z", 2, d2)}


def test_snapshot_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    at = [dt.datetime(2024, 1, d, 6) for d in (1, 2, 3)]

    def take(rows, when):
        snapshot(spark.createDataFrame(rows, "k string, tier string, total int"), path, "k", ["tier"], when)

    def stored():
        return sorted(repr((r.k, r.tier, r.total, r.dbt_valid_from.day, r.dbt_valid_to and r.dbt_valid_to.day))
                      for r in read_versions(spark, path).collect())

    def expected(*rows):
        return sorted(map(repr, rows))

    take([("a", "X", 1), ("b", None, 1), ("gone", "X", 1)], at[0])
    second = expected(("a", "X", 1, 1, None), ("b", None, 1, 1, 2), ("b", "Y", 2, 2, None), ("gone", "X", 1, 1, None), ("new", "X", 1, 2, None))
    for _ in range(2):  # the second time is the same run again
        take([("a", "X", 9), ("b", "Y", 2), ("new", "X", 1)], at[1])
        assert stored() == second
    take([("b", None, 3)], at[2])
    assert stored() == expected(
        ("a", "X", 1, 1, None), ("b", None, 1, 1, 2), ("b", "Y", 2, 2, 3), ("b", None, 3, 3, None), ("gone", "X", 1, 1, None), ("new", "X", 1, 2, None))


def test_fact_fan_out(spark):
    dim = spark.createDataFrame(
        [("u@x", "GOLD", 1, Decimal(1), False), ("u@x", "SILVER", 2, Decimal(2), True)],
        "customer_vpa string, customer_tier string, total_txns bigint, total_spend_inr decimal(38,2), is_current boolean")
    columns = [c for c in transactions._FACT_COLUMNS if not c.startswith("customer_")]
    txns = spark.createDataFrame([("u@x",)], "sender_vpa string").select(
        *[F.col(c) if c == "sender_vpa" else F.lit("v").alias(c) for c in columns])
    assert [r.customer_tier for r in transactions.fct_transactions(txns, dim).collect()] == ["SILVER"]
    assert transactions.fct_transactions(txns, dim, all_versions=True).count() == 2


def test_fraud_scores(spark):
    rules = {"A": "0.60", "B": "0.65", "C": "0.70", "D": "0.75", "E": "0.85"}
    rows = [(f"t{n}", n, Decimal(s)) for n, s in rules.items()] + [("two", "A", Decimal("0.60")), ("two", "B", Decimal("0.65"))]
    df = spark.createDataFrame(rows, "txn_id string, signal_type string, signal_score decimal(3,2)").withColumns(
        {"sender_vpa": F.lit("u"), "txn_timestamp": F.lit("2024-01-01").cast("timestamp_ntz")})
    got = {r.txn_id: (r.fraud_score, r.fraud_risk_tier, r.triggered_rules) for r in fraud.fct_fraud_scores(df).collect()}
    assert got["tE"] == (Decimal("0.85"), "CRITICAL", ["E"])
    assert [got[f"t{n}"][1] for n in "ABCD"] == ["HIGH"] * 4
    assert got["two"] == (Decimal("1.00"), "CRITICAL", ["A", "B"])


RAW_SCHEMA = ", ".join(f"{c} {t}" for c, t in raw_table.RAW_TYPES.items()) + ", _source_date date, _source string"


def raw_rows(spark, *rows):
    base = dict.fromkeys(raw_table.RAW_TYPES) | {"_source_date": dt.date(2024, 1, 1), "_source": "csv"}
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], RAW_SCHEMA)


def test_staging_keeps_latest_and_drops_ids_with_a_missing_time(spark):
    t = dt.datetime(2024, 1, 1, 5, 59)
    raw = raw_rows(
        spark,
        {"txn_id": "1", "txn_timestamp": t, "amount": Decimal("50000"), "status": "error"},
        {"txn_id": "1", "txn_timestamp": t + dt.timedelta(hours=1), "amount": Decimal("50000.01"), "status": " completed"},
        {"txn_id": "2", "txn_timestamp": t}, {"txn_id": "2"},
        {"txn_id": None, "txn_timestamp": t},
        {"txn_id": " 3", "txn_timestamp": t}, {"txn_id": "3", "txn_timestamp": t, "currency": " usd "},
    )
    got = sorted((r.txn_id, r.txn_hour, r.amount_inr, r.status, r.currency, r.is_high_value, r.is_off_hours)
                 for r in staging.stage(raw, RUN).collect())
    assert got == [
        ("1", 6, Decimal("50000.01"), "SUCCESS", "INR", True, False),
        ("3", 5, Decimal("0.00"), "UNKNOWN", "USD", False, True),
    ]


def test_high_value_threshold_is_a_setting(spark):
    raw = raw_rows(spark, {"txn_id": "1", "txn_timestamp": dt.datetime(2024, 1, 1), "amount": Decimal("600")})
    low = Run(RUN.run_date, RUN.run_ts, "test", settings=Settings(high_value_threshold=Decimal("500")))
    assert staging.stage(raw, low).first().is_high_value and not staging.stage(raw, RUN).first().is_high_value


def test_modes_break_ties_and_let_missing_devices_win(spark):
    rows = [("a", "Pune", None)] * 2 + [("a", "Agra", "WEB")] * 2 + [("b", None, None)] * 3 + [("b", "Pune", "IOS")] + [("c", None, "IOS")]
    got = {r.sender_vpa: (r.home_city, r.primary_device_type) for r in customers.sender_modes(
        spark.createDataFrame(rows, "sender_vpa string, city string, device_type string")).collect()}
    assert got == {"a": ("Agra", "WEB"), "b": ("Pune", None), "c": (None, "IOS")}


def test_scratch_tables_go_away(spark):
    df = spark.range(5)
    with stored_for(df, "few") as rows:
        assert rows.count() == 5
        files = rows.inputFiles()
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert stored(df, "few").count() == 5


def fake_session(setting, master):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context), made


def test_shared_dir_comes_from_the_session():
    session, made = fake_session("hdfs://shared/tmp/", "yarn")
    assert shared_dir(session) == "hdfs://shared/tmp" and made == ["hdfs://shared/tmp/"]
    session, _ = fake_session(None, "yarn")
    with pytest.raises(ValueError):
        shared_dir(session)
    session, made = fake_session(None, "local[2]")
    assert shared_dir(session) == made[0]


def test_hot_key_plans_broadcast_only_the_key_list(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("string").alias("k"), F.lit(None).cast("date").alias("d"))
    hot = hot_keys(df, {"k": F.col("k"), "d": F.col("d")}, SkewPolicy(10, 10))
    flagged = flag_hot(df, hot, "is_hot")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Exchange hashpartitioning" not in plan
    assert flagged.where("is_hot").count() == 100


def test_deduplication_limits_copies_before_the_shuffle(spark):
    plan = staging.stage(raw_rows(spark, {"txn_id": "1"}), RUN)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning(_key"):]
    assert "WindowGroupLimit" in before_shuffle and plan.count("Exchange hashpartitioning") == 1


def test_sender_columns_need_one_shuffle_and_one_sort(spark):
    stg = spark.createDataFrame([], "txn_id string, sender_vpa string, txn_timestamp timestamp_ntz, txn_date date, txn_hour bigint, status string")
    plan = with_sender_timeline(stg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_an_unreadable_table_is_not_overwritten(spark, tmp_path):
    path = tmp_path / "table"
    (path / "day=2024-01-01").mkdir(parents=True)
    (path / "day=2024-01-01" / "part-0.parquet").write_bytes(b"no parquet")
    change = spark.createDataFrame([("k", dt.date(2024, 1, 1))], "k string, day date")
    with pytest.raises(Exception):
        upsert(change, str(path), "k", "day")
    assert (path / "day=2024-01-01" / "part-0.parquet").read_bytes() == b"no parquet"


def test_merge_refuses_two_rows_of_a_key(spark, tmp_path):
    twice = spark.createDataFrame([("k", 1, dt.date(2024, 1, 1)), ("k", 2, dt.date(2024, 1, 1))], "k string, v int, day date")
    with pytest.raises(DuplicateKey):
        upsert(twice, str(tmp_path / "table"), "k", "day")


def test_null_keys_do_not_pile_up(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a"), ("x", "b")], "k string, tier string")
    for hour in range(3):
        snapshot(rows, str(tmp_path / "versions"), "k", ["tier"], dt.datetime(2024, 1, 1, hour))
    assert read_versions(spark, str(tmp_path / "versions")).count() == 2


def test_padded_ids_are_one_transaction(spark):
    from paylake.config import Run
    from paylake.fixed import CANONICAL_COLUMNS
    from paylake.plans import staging
    from paylake.sources.raw import RAW_TYPES

    run = Run(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), "test")
    base = dict.fromkeys(CANONICAL_COLUMNS) | {"sender_vpa": "a@x"}
    rows = [base | {"txn_id": i, "txn_timestamp": t, "city": c} for i, t, c in (
        ("3", dt.datetime(2024, 1, 1, 1), "old"), (" 3", dt.datetime(2024, 1, 1, 2), "new"))]
    schema = ", ".join(f"{c} {RAW_TYPES[c]}" for c in CANONICAL_COLUMNS) + ", _source_date date, _source string"
    raw = spark.createDataFrame([(*[r[c] for c in CANONICAL_COLUMNS], dt.date(2024, 1, 1), "csv") for r in rows], schema)
    assert [(r.txn_id, r.city) for r in staging.stage(raw, run).collect()] == [("3", "New")]
