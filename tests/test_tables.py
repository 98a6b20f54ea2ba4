"""Versions of whole tables, the key index, pages, histories over a range, and joins by time."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylake.config import Run, SkewPolicy
from paylake.operators import upsert as merging, versioned
from paylake.operators.asof import as_of
from paylake.operators.key_index import KeyIndex, _folders
from paylake.operators.pages import PageDirectory, page_after
from paylake.operators.skew import hot_keys
from paylake.operators.upsert import upsert
from paylake.operators.versions import ClockWentBack, read_versions, snapshot
from paylake.plans import customers, history, velocity
from paylake.tables import Tables

RUN = Run(dt.date(2024, 1, 5), dt.datetime(2024, 1, 6), "test")


def files(folder):
    """Data files and when they were written."""
    found = {}
    for at, _, names in os.walk(folder):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(at, n)
                found[os.path.relpath(path, folder)] = os.stat(path).st_mtime_ns
    return found


# -- versions ----------------------------------------------------------------------------


def test_a_replace_that_stops_halfway_leaves_the_old_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), RUN)
    tables.replace(spark.range(3).withColumn("d", F.lit(RUN.run_date)), "fct_transactions", "d")
    before = tables.read("fct_transactions")

    @F.udf("bigint")
    def broken(x):
        if x == 70:
            raise RuntimeError("stopped")
        return x

    with pytest.raises(Exception, match="stopped"):
        rows = spark.range(0, 100, 1, 10).withColumn("id", broken("id")).withColumn("d", F.lit(RUN.run_date))
        tables.replace(rows, "fct_transactions", "d")
    assert {r.id for r in tables.read("fct_transactions").collect()} == {0, 1, 2}

    def not_finished(folder):  # all files are there, yet the writer dies before the switch
        spark.range(9).write.parquet(folder)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        versioned.replace(spark, tables.path("fct_transactions"), not_finished)
    assert tables.read("fct_transactions").count() == before.count() == 3


def test_readers_of_the_old_version_finish_and_old_ones_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versioned.current(spark, path) is None
    made = [versioned.replace(spark, path, spark.range(n).write.parquet) for n in (1, 2)]
    reading = spark.read.parquet(made[1])
    made.append(versioned.replace(spark, path, spark.range(3).write.parquet))
    assert reading.count() == 2 and versioned.current(spark, path) == made[2]
    versioned.replace(spark, path, spark.range(4).write.parquet)
    assert sorted(n for n in os.listdir(path) if n.startswith("v")) == sorted(os.path.basename(p) for p in [made[2], versioned.current(spark, path)])
    assert len(os.listdir(os.path.join(path, versioned.POINTERS))) >= 2


# -- key index ---------------------------------------------------------------------------

DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]


def stored_rows(spark, path):
    return {(r.k, r.v, r.day) for r in spark.read.parquet(path).collect()}


def change(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int, day date")


def test_a_merge_touches_only_its_buckets_and_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{i}", i, DAYS[i % 4]) for i in range(400)]
    upsert(change(spark, *rows), path, "k", "day", per_bucket=20)
    index = KeyIndex(spark, path, "k", "day", 20)
    assert index.buckets == 32
    before = files(path), files(index.folder)
    assert upsert(change(spark, ("k1", -1, DAYS[2])), path, "k", "day", per_bucket=20) == [DAYS[1], DAYS[2]]
    written = [{f for f, t in files(p).items() if old.get(f) != t} | {f for f in old if f not in files(p)} for p, old in zip((path, index.folder), before)]
    assert {f.split("/")[0] for f in written[0]} == {"day=2024-01-02", "day=2024-01-03"}
    assert len({f.split("/")[0] for f in written[1]}) == 1
    want = {r for r in rows if r[0] != "k1"} | {("k1", -1, DAYS[2])}
    assert stored_rows(spark, path) == want
    entries = {(r.k, r.day) for r in index.entries(list(range(32))).collect()}
    assert entries == {(k, d) for k, _, d in want}
    plan = index.entries([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan


@pytest.mark.parametrize("stop_at", [1, 2, 3])
def test_a_merge_that_stops_anywhere_is_repaired_by_the_next(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "t")
    upsert(change(spark, *[(f"k{i}", i, DAYS[i % 4]) for i in range(40)]), path, "k", "day", per_bucket=5)
    steps, real = [], KeyIndex.replace

    def counted(kind, work):
        def run(*a, **kw):
            steps.append(kind)
            if len(steps) == stop_at:
                raise RuntimeError("stopped")
            return work(*a, **kw)
        return run

    moved = change(spark, ("k1", -1, DAYS[4]), ("new", 0, DAYS[0]))
    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "replace", counted("index", real))
        m.setattr(merging, "replace_partitions", counted("table", merging.replace_partitions))
        with pytest.raises(RuntimeError):
            upsert(moved, path, "k", "day", per_bucket=5)
    upsert(moved, path, "k", "day", per_bucket=5)
    upsert(change(spark, ("k1", -2, DAYS[0])), path, "k", "day", per_bucket=5)
    want = {(f"k{i}", i, DAYS[i % 4]) for i in range(40) if i != 1} | {("k1", -2, DAYS[0]), ("new", 0, DAYS[0])}
    assert stored_rows(spark, path) == want and len(stored_rows(spark, path)) == spark.read.parquet(path).count()


def test_the_index_is_built_for_an_old_table_and_grows(spark, tmp_path):
    path = str(tmp_path / "t")
    change(spark, ("a", 1, DAYS[0])).write.partitionBy("day").parquet(path)
    upsert(change(spark, ("a", 2, DAYS[1])), path, "k", "day", per_bucket=3)
    assert stored_rows(spark, path) == {("a", 2, DAYS[1])} and [n for n, _ in _folders(spark, path)] == [1]
    upsert(change(spark, *[(f"k{i}", i, DAYS[0]) for i in range(50)]), path, "k", "day", per_bucket=3)
    upsert(change(spark, ("a", 3, DAYS[0])), path, "k", "day", per_bucket=3)
    assert [n for n, _ in _folders(spark, path)] == [32] and ("a", 3, DAYS[0]) in stored_rows(spark, path)


# -- pages -------------------------------------------------------------------------------


def test_a_far_page_reads_only_its_range(spark):
    rows = spark.range(0, 2_000_000, 1, 8).select((F.col("id") * 7 % 2_000_000).alias("id"))
    directory = PageDirectory.build(rows, ["id"])
    page = directory.page(1_000_000, 300)
    assert [r.id for r in page.collect()] == list(range(1_000_000, 1_000_300))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and directory.ranges.count() > 1
    border = directory.ranges.orderBy("_range").collect()[1]["begin"]
    assert [r.id for r in directory.page(border - 5, 10).collect()] == list(range(border - 5, border + 5))
    assert directory.page(3_000_000, 5).count() == 0 and [r.id for r in directory.page(1_999_998, 5).collect()] == [1_999_998, 1_999_999]
    assert [r.id for r in page_after(rows, ["id"], (1_234_567,), 3).collect()] == [1_234_568, 1_234_569, 1_234_570]
    with pytest.raises(ValueError):
        directory.page(0, 501)


# -- history over a range ----------------------------------------------------------------


@pytest.fixture(scope="module")
def flagged(spark):
    rnd, rows = random.Random(5), []
    for i in range(1_500):
        sender = rnd.choice(["a@x", "b@x", "c@y", "d@y", None])
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 33))
        rows.append((f"T{i}", sender, sender and sender[-1], f"r{rnd.randint(0, 20)}@z", day, Decimal(rnd.choice([10, 3_000, 60_000])),
                     rnd.choice(["SUCCESS", "FAILED", "REVERSED"]), rnd.choice(["Pune", "Agra", None]), rnd.choice(["WEB", "IOS", None]), rnd.random() < 0.1))
    columns = "txn_id string, sender_vpa string, sender_bank string, receiver_vpa string, txn_date date, amount_inr decimal(15,2), status string, city string, device_type string, is_off_hours boolean"
    df = spark.createDataFrame(rows, columns).withColumn("is_high_value", F.col("amount_inr") > 50_000)
    return df.withColumn("is_suspicious", F.col("is_high_value") & F.col("is_off_hours"))


def contents(spark, path):
    rows = read_versions(spark, path)
    return sorted(repr(r) for r in rows.select(*sorted(rows.columns)).collect())


def test_a_range_of_snapshots_equals_the_loop(spark, tmp_path, flagged):
    """Thirty dates with gaps, in one go, in two goes, and one by one."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(33) if i not in (4, 5, 20)]
    snaps = [(d, dt.datetime.combine(d, dt.time(3))) for d in days]
    assert len(snaps) == 30
    paths = [str(tmp_path / n) for n in ("range", "halves", "loop")]
    history.snapshot_range(flagged, paths[0], snaps)
    for some in (snaps[:11], snaps[11:]):
        history.snapshot_range(flagged, paths[1], some)
    for day, at in snaps:
        snapshot(customers.customers_current(flagged.where(F.col("txn_date") <= F.lit(day))), paths[2], "sender_vpa", history.TRACKED_CUSTOMER_COLUMNS, at)
    want = contents(spark, paths[2])
    assert contents(spark, paths[0]) == want and contents(spark, paths[1]) == want and len(want) > 20
    history.snapshot_range(flagged, paths[0], snaps[-1:])
    assert contents(spark, paths[0]) == want
    with pytest.raises(ClockWentBack):
        history.snapshot_range(flagged, paths[0], snaps[:2])
    with pytest.raises(ValueError):
        history.snapshot_range(flagged, paths[0], snaps[::-1])


# -- joins by time -----------------------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [None, 0, 60])
def test_as_of_against_brute_force(spark, hot_rows):
    rnd, start = random.Random(2), dt.datetime(2024, 1, 1)

    def some_time():
        return start + dt.timedelta(hours=rnd.choice([0, 24, 48]) + rnd.randint(0, 30), microseconds=rnd.choice([0, 1]))

    left = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice([some_time(), None] if i % 20 == 0 else [some_time()])) for i in range(400)]
    right = sorted({(k, some_time()) for k in ["a", "b", None] for _ in range(12)}, key=repr)
    right = [(k, t, n) for n, (k, t) in enumerate(right)]
    rows = spark.createDataFrame(left, "i int, k string, at timestamp_ntz")
    values = spark.createDataFrame(right, "k string, since timestamp_ntz, n int")
    hot = None if hot_rows is None else hot_keys(rows, {"k": F.col("k")}, SkewPolicy(hot_rows, 1000))
    got = {r.i: r.v and r.v.n for r in as_of(rows, values, "k", "at", "since", "v", hot).collect()}
    want = {}
    for i, k, at in left:
        found = [(t, n) for q, t, n in right if k is not None and at is not None and q == k and t <= at]
        want[i] = max(found)[1] if found else None
    assert got == want


def test_as_of_makes_no_product(spark):
    rows = spark.createDataFrame([], "k string, at timestamp_ntz")
    plan = as_of(rows, rows.withColumnRenamed("at", "since"), "k", "at", "since", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_velocity_against_brute_force(spark):
    rnd, base = random.Random(9), dt.datetime(2024, 1, 1, 23, 50)
    rows = []
    for i in range(500):
        at = base + dt.timedelta(seconds=rnd.choice([0, 1, 299, 300, 301, 599, 600, 601, 900, 86_400]), microseconds=rnd.choice([0, 999_999]))
        rows.append((f"T{i:03d}", rnd.choice(["hot", "hot", "x", None]), rnd.choice(["p", "q", None]), rnd.choice(["Pune", None]), at, Decimal(i)))
    df = spark.createDataFrame(rows, "txn_id string, sender_vpa string, receiver_vpa string, city string, txn_timestamp timestamp_ntz, amount_inr decimal(15,2)")
    got = {r.txn_id: (r.sender_5min_txns, r.sender_5min_amount_inr, r.is_new_payee, r.is_new_city) for r in velocity.sender_velocity(df).collect()}
    assert len(got) == 500
    for i, sender, payee, city, at, _ in rows:
        second = at.replace(microsecond=0)
        near = [r for r in rows if r[1] == sender and second - dt.timedelta(seconds=300) <= r[4].replace(microsecond=0) <= second]
        earlier = [r for r in rows if r[1] == sender and (r[4], r[0]) < (at, i)]
        assert got[i] == (len(near), sum(r[5] for r in near), sender is not None and payee is not None and all(r[2] != payee for r in earlier),
                          sender is not None and city is not None and all(r[3] != city for r in earlier))
