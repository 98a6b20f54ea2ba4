"""Marts of touched days against whole builds, and the increment as a stream."""

import dataclasses
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from paylake import daily
from paylake.config import Run
from paylake.fixed import CANONICAL_COLUMNS
from paylake.functions.audit import AUDIT_COLUMNS
from paylake.plans import staging
from paylake.sources import landing, raw as raw_table
from paylake.streaming.increment import stage_stream
from paylake.tables import Tables

FIRST = dt.date(2024, 1, 5)
STAGES = ["ingest", "load", "prep", "snapshot", "marts"]


def deliver(folder, day, lines):
    """A statement of some lines (id, sender, amount, status, time) and a page of one record."""
    path = folder / "statements"
    path.mkdir(exist_ok=True)
    head = "txn_id,sender_vpa,receiver_vpa,amount,status,txn_timestamp\n"
    (path / f"bank_{day}.csv").write_text(head + "".join(f"{i},{s},r@y,{a},{st},{t}\n" for i, s, a, st, t in lines))
    page = folder / "feed" / str(day)
    page.mkdir(parents=True, exist_ok=True)
    record = dict.fromkeys(CANONICAL_COLUMNS) | {"txn_id": f"P{day}", "sender_vpa": "p@x", "receiver_vpa": "r@y", "amount": 5, "status": "SUCCESS", "txn_timestamp": f"{day} 09:00:00"}
    (page / "page.json").write_text(json.dumps({"records": [record], "total": 1, "count": 1, "next_cursor": None, "page": 1}))
    return daily.Inputs(str(path), str(folder / "feed"))


def contents(tables, mart):
    rows = tables.read(mart).drop(*AUDIT_COLUMNS, "_processed_ts", "ingested_at")
    return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))


def days_written(folder, before):
    return {n for n in os.listdir(folder) if "=" in n and before.get(n) != sorted(os.listdir(os.path.join(folder, n)))}


def listing(folder):
    return {n: sorted(os.listdir(os.path.join(folder, n))) for n in os.listdir(folder) if "=" in n}


def test_marts_of_touched_days_equal_a_whole_build(spark, tmp_path):
    root, days = str(tmp_path / "lake"), [FIRST + dt.timedelta(days=i) for i in range(4)]
    for n, day in enumerate(days):
        lines = [(f"T{n}-{i}", f"s{i % 3}@x", 100 + i, "FAILED" if i % 2 else "SUCCESS", f"{day} {i:02d}:10:00") for i in range(9)]
        if n == 1:
            lines.append((" T0-4", "s1@x", 7, "REVERSED", f"{days[0]} 23:00:00"))  # a later copy of a row of the first day
        if n == 3:
            lines.append(("BIG", "s2@x", 60_000, "SUCCESS", f"{day} 02:00:00"))  # changes the sender's tier
        inputs = deliver(tmp_path, day, lines)
    run = Run(days[0], dt.datetime(2024, 1, 8, 1), "test")
    tables = [Tables(spark, root, dataclasses.replace(run, run_date=d, run_ts=run.run_ts + dt.timedelta(minutes=i))) for i, d in enumerate(days)]

    def go(n, **kw):
        daily.run_date(spark, root, inputs, tables[n].run, stages=STAGES, **kw)

    go(0)
    folders = {m: tables[0].folder(m) for m in daily.MARTS}
    before = {m: listing(f) for m, f in folders.items()}
    go(1)
    second = f"txn_date={days[1]}"
    assert {m: tables[1].folder(m) for m in daily.MARTS} == folders  # the versions stay, days in them change
    # The newest staged day is read again, and the later copy changed a row of the first day.
    assert days_written(folders["fct_daily_summary"], before["fct_daily_summary"]) == {f"txn_date={days[0]}", second}
    go(2)
    before = {m: listing(f) for m, f in folders.items()}
    go(3)
    assert days_written(folders["fct_customer_activity"], before["fct_customer_activity"]) == {f"txn_date={d}" for d in days[2:]}
    # The sender with a new tier has facts on all days.
    assert days_written(folders["fct_transactions"], before["fct_transactions"]) == {f"txn_date={d}" for d in days}
    grown = {m: contents(tables[3], m) for m in daily.MARTS}
    assert daily.build_marts(tables[3]) == {m: () for m in daily.MARTS}
    for m in daily.MARTS:
        daily.Touched(spark, root).note([m], None)
    daily.build_marts(tables[3])
    for m in daily.MARTS:
        assert contents(tables[3], m) == grown[m], m
    assert all(tables[3].folder(m) != folders[m] for m in daily.MARTS)


def test_a_run_that_stops_before_its_marts_is_made_up_for(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    days = [FIRST, FIRST + dt.timedelta(days=1)]
    for day in days:
        inputs = deliver(tmp_path, day, [(f"A{day}-{i}", "s@x", 10, "SUCCESS", f"{day} 10:0{i}:00") for i in range(3)])
    first, second = [Tables(spark, root, Run(d, dt.datetime(2024, 1, 8, n), "test")) for n, d in enumerate(days)]
    daily.run_date(spark, root, inputs, first.run, stages=STAGES)
    daily.run_date(spark, root, inputs, second.run, stages=STAGES[:-1])
    with monkeypatch.context() as m:
        m.setattr(daily.Tables, "replace_days", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            daily.build_marts(second)
    assert daily.build_marts(second, ["fct_transactions"])["fct_transactions"][-1] == days[1]
    ranks = {r.txn_id: r.sender_lifetime_rank for r in second.read("fct_transactions").where("sender_vpa = 's@x'").collect()}
    assert sorted(ranks.values()) == [1, 2, 3, 4, 5, 6]
    assert daily.build_marts(second)["fct_fraud_scores"][-1] == days[1]


def test_the_stream_equals_the_batch_after_late_files(spark, tmp_path):
    root, raw, stg = (str(tmp_path / n) for n in ("landing", "raw", "stg"))
    run = Run(FIRST, dt.datetime(2024, 1, 8), "test")

    def land(source, day, *rows):
        columns = ["txn_id", "sender_vpa", "amount", "txn_timestamp", "status"]
        landing.land(spark.createDataFrame([(*r,) for r in rows], ", ".join(f"{c} string" for c in columns)), root, source, day)

    def stream(files=None):
        query = stage_stream(spark, root, raw, stg, str(tmp_path / "checkpoint"), run, files)
        query.awaitTermination()
        rows = spark.read.parquet(stg)
        return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))

    def batch():
        rows = staging.stage(raw_table.accepted(landing.landed(landing.read_landing(spark, root))), run)
        return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))

    late, later = FIRST - dt.timedelta(days=2), FIRST + dt.timedelta(days=1)
    land("csv", FIRST, ("1", "a@x", "5", f"{FIRST} 10:00:00", "SUCCESS"), ("2", "b@x", "6", f"{FIRST} 11:00:00", "FAILED"), ("3", "c@x", "x", f"{FIRST} 11:00:00", None))
    assert stream() == batch() and len(batch()) == 2
    # A newer copy on the next day, an older one that comes late, a copy without a time, and new rows.
    land("api", later, ("1", "a@x", "50", f"{later} 10:00:00", "REVERSED"), ("4", "d@x", "1", f"{later} 10:00:00", None))
    land("csv", late, (" 1", "a@x", "1", f"{late} 10:00:00", "PENDING"), ("2", "b@x", "6", None, "SUCCESS"), ("5", "e@x", "9", f"{late} 01:00:00", "SUCCESS"))
    got = stream(files=1)
    assert got == batch() and len(got) == 3
    assert stream() == got  # nothing new
