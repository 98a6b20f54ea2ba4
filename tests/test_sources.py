"""Statement files, pages, landing, manifest, raw load and the daily run on small inputs."""

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paylake import daily
from paylake.config import Run
from paylake.fixed import CANONICAL_COLUMNS
from paylake.operators.pages import PageDirectory, page_after
from paylake.operators.versions import ClockWentBack
from paylake.quality.evaluate import QualityError, enforce, evaluate
from paylake.quality.freshness import freshness
from paylake.quality.rules import RULES, Rule
from paylake.sources import landing, ledger, manifest, pages, raw as raw_table, statements
from paylake.sources.pages import IncompletePull

DAY = dt.date(2024, 1, 5)
RUN = Run(DAY, dt.datetime(2024, 1, 6, 2), "test")


def test_statements(spark, tmp_path):
    (tmp_path / f"bank_{DAY}_a.csv").write_text(
        "txn_id,sender_vpa,amount,currency,remarks\n"
        "1,a@x,10,,first\n"
        "1,a@x,11,INR,again\n"
        "2,b@x,NA,USD,\"said \"\"hi\"\", left\"\n"
        "3,c@x\n"
        "4,d@x,1,INR,r,too,many\n"
        ",e@x,1,INR,no id\n"
        ",f@x,1,INR,no id either\n")
    (tmp_path / f"{DAY}_b.csv").write_text(
        " Transaction_ID ,FROM_VPA,txn_amount,IP,extra\n1,zz@x,99,10.0.0.1,e\n5, g@x,oops,10.0.0.2,e\n")
    (tmp_path / "bank_2024-01-06.csv").write_text("txn_id\n9\n")
    (tmp_path / f"notes_{DAY}.txt").write_text("txn_id\n8\n")
    df = statements.read_statements(spark, str(tmp_path), RUN)
    assert df.columns == list(CANONICAL_COLUMNS)
    got = {(r.txn_id, r.sender_vpa): (r.amount, r.currency, r.remarks, r.ip_address, r.ingested_at) for r in df.collect()}
    now = "2024-01-06 02:00:00"
    # File names sort "2024..." before "bank...", so the aliased file comes first.
    assert got == {
        ("1", "zz@x"): ("99", None, None, "10.0.0.1", now),
        ("5", " g@x"): ("oops", None, None, "10.0.0.2", now),
        ("2", "b@x"): (None, "USD", 'said "hi", left', None, now),
        ("3", "c@x"): (None, "INR", None, None, now),
        (None, "e@x"): ("1", "INR", "no id", None, now),
    }
    landed = {r.txn_id: r.amount for r in landing.coerced(df).collect()}
    assert landed == {"1": 99.0, "5": None, "2": None, "3": None, None: 1.0}


def test_every_line_lands_or_is_rejected(spark, tmp_path):
    (tmp_path / f"a_{DAY}.csv").write_text(
        "txn_id,amount,amount,txn_timestamp,Amount\n1,,7,05/01/2024 10:00,\n2,5,6,05-01-2024 10:00:01,\n3,x,,2024-01-05 10:00:00,\n"
        "4,1,,soon,\n5,1,,2024-01-05 10:00:00,,6,7\n6,,,2024-01-05 10:00:00,9\n")
    root = str(tmp_path / "landing")
    statements.land_statements(spark, str(tmp_path), root, RUN)
    arrived = landing.read_landing(spark, root, [DAY])
    good = {r.txn_id: (r.amount, r.txn_timestamp) for r in landing.landed(arrived).collect()}
    assert good == {"1": (7.0, "2024-01-05 10:00:00"), "2": (5.0, "2024-01-05 10:00:01"), "6": (9.0, "2024-01-05 10:00:00")}
    bad = {r.txn_id: r.reject_reason for r in landing.rejected(arrived).collect()}
    assert bad == {"3": "amount cannot be read: x", "4": "txn_timestamp cannot be read: soon", "5": "more than 5 fields"}
    raw = str(tmp_path / "raw")
    assert raw_table.load(arrived, raw, [DAY]) == {str(DAY): 3}
    kept = {r.txn_id: (r.amount, r.reject_reason) for r in raw_table.read_rejects(spark, raw).collect()}
    assert kept == {"3": ("x", "amount cannot be read: x"), "4": ("1", "txn_timestamp cannot be read: soon"), "5": ("1", "more than 5 fields")}


def counted_runs(spark, work):
    """How often a source of rows is computed while ``work`` runs."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(x):
        seen.add(1)
        return x

    work(passed)
    return seen.value


def test_rows_are_judged_in_one_run_of_their_plan(spark, tmp_path):
    """Ten rows, good and bad, reach the landing folder and the raw table; the input runs once for each."""
    rows = [record(i, amount="x" if i % 3 == 0 else "1.5", status="S" * 21 if i % 5 == 0 else "SUCCESS") for i in range(10)]
    df = spark.createDataFrame([tuple(map(str, r.values())) for r in rows], ", ".join(f"{c} string" for c in CANONICAL_COLUMNS))
    root, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    assert counted_runs(spark, lambda f: landing.land(df.withColumn("city", f("city")), root, "csv", DAY)) == 10
    arrived = landing.read_landing(spark, root, [DAY])
    assert (landing.landed(arrived).count(), landing.rejected(arrived).count()) == (6, 4)
    assert counted_runs(spark, lambda f: raw_table.load(arrived.withColumn("city", f("city")), raw, [DAY])) == 10
    assert (raw_table.read_raw(spark, raw).count(), raw_table.read_rejects(spark, raw).count()) == (5, 5)


def test_a_date_without_rejects_clears_the_old_ones(spark, tmp_path):
    bad = spark.createDataFrame([tuple(map(str, record(1, amount="x").values()))], ", ".join(f"{c} string" for c in CANONICAL_COLUMNS))
    good = bad.withColumn("amount", F.lit("2"))
    root, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    for df, want in ((bad, (0, 1)), (good, (1, 0)), (good.limit(0), (0, 0)), (bad, (0, 1))):
        landing.land(df, root, "csv", DAY)
        arrived = landing.read_landing(spark, root, [DAY])
        assert (landing.landed(arrived).count(), landing.rejected(arrived).count()) == want
        raw_table.load(arrived, raw, [DAY])
        assert (raw_table.read_raw(spark, raw).count(), raw_table.read_rejects(spark, raw).count()) == want


def test_headers_take_one_job_for_any_number_of_files(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}_{DAY}.csv").write_text("txn_id,amount\n1,2\n")
        spark.sparkContext.setJobGroup(f"headers-{n}", "")
        statements.read_statements(spark, str(folder), RUN)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"headers-{n}"))

    assert jobs(9) == jobs(2)


def test_amounts_as_text_and_whole_file_pages(spark, tmp_path):
    rows = [record(1, amount="12.50"), record(2, amount=3)]
    envelope = {"records": rows, "total": 2, "count": 2, "next_cursor": None, "page": 1}
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "page.json").write_text(json.dumps(envelope, indent=1))
    with pytest.raises(IncompletePull):
        pages.read_feed(spark, str(tmp_path / "feed"), DAY, DAY)
    got = landing.coerced(pages.read_feed(spark, str(tmp_path / "feed"), DAY, DAY, multi_line=True)).collect()
    assert {r.txn_id: r.amount for r in got} == {"P1": 12.5, "P2": 3.0}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "page.json").write_text("")
    with pytest.raises(IncompletePull):
        pages.read_feed(spark, str(tmp_path / "none"), DAY, DAY)


def deliver(tmp_path, day, header, line, **extra):
    """A statement of one line, and a page with one record."""
    (tmp_path / f"bank_{day}.csv").write_text(f"{header}\n{line}\n")
    write_pages(tmp_path / "feed" / str(day), [record(1, day) | extra])


@pytest.mark.parametrize("at_once", [False, True])
def test_a_missing_required_column_stops_only_its_own_date(spark, tmp_path, at_once):
    root, days = str(tmp_path / "landing"), [dt.date(2024, 1, d) for d in (3, 4, 5)]
    deliver(tmp_path, days[0], "txn_id,sender_vpa,receiver_vpa,amount,txn_timestamp", "1,a@x,b@y,5,2024-01-03 10:00:00")
    deliver(tmp_path, days[1], "Transaction_ID,from_vpa,to_vpa,TXN_AMOUNT,timestamp", "1,a@x,b@y,5,2024-01-04 10:00:00", channel="app")
    deliver(tmp_path, days[2], "txn_id,sender_vpa,receiver_vpa,amount_inr,txn_timestamp", "1,a@x,b@y,5,2024-01-05 10:00:00")
    for some in [days] if at_once else [[d] for d in days]:
        statements.land_statements(spark, str(tmp_path), root, RUN, some)
        pages.land_feed(spark, str(tmp_path / "feed"), root, RUN, dates=some)
    found = [manifest.save_manifest(spark, root, str(tmp_path / "m"), d) for d in days[:2]]
    assert all(m["ready"] and m["csv_rows"] == m["api_rows"] == 1 for m in found)
    assert "csv:-status" in found[0]["schema_drift"] and "amount" not in found[0]["schema_drift"]
    assert "api:+channel" in found[1]["schema_drift"]
    with pytest.raises(manifest.NotReady, match="csv:\\+amount_inr,csv:-amount"):
        manifest.save_manifest(spark, root, str(tmp_path / "m"), days[2])
    entries = {(r.source, str(r.date)): (r.missing, r.extra) for r in ledger.read_ledger(spark, root).collect()}
    assert len(entries) == 6 and entries["api", "2024-01-04"] == ([], ["channel"]) and entries["csv", "2024-01-05"][1] == ["amount_inr"]


def test_the_ledger_has_a_row_for_each_file(spark, tmp_path):
    (tmp_path / f"a_{DAY}.csv").write_text("txn_id,amount\n1,2\n")
    (tmp_path / f"b_{DAY}.csv").write_text("txn_id,sender_vpa\n")  # a header alone
    statements.land_statements(spark, str(tmp_path), str(tmp_path / "landing"), RUN)
    got = {r.file.rsplit("/", 1)[1][0]: r.missing for r in ledger.read_ledger(spark, str(tmp_path / "landing"), [DAY]).collect()}
    assert "amount" not in got["a"] and "amount" in got["b"] and "sender_vpa" in got["a"]
    assert ledger.read_ledger(spark, str(tmp_path / "nothing")).count() == 0


def test_dates_landed_together_equal_dates_landed_one_by_one(spark, tmp_path, inputs):
    days = [DAY, dt.date(2024, 1, 6)]
    (tmp_path / "statements" / "both_2024-01-05_2024-01-06.csv").write_text("txn_id,amount,txn_timestamp\nB1,5,2024-01-05 10:00:00\nC5-1,x,\n")

    def landed(root):
        return sorted(map(repr, landing.read_landing(spark, root).collect())), sorted(map(repr, ledger.read_ledger(spark, root).collect()))

    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    statements.land_statements(spark, inputs.statements, one, RUN, days)
    pages.land_feed(spark, inputs.feed, one, RUN, dates=days)
    for day in days:
        statements.land_statements(spark, inputs.statements, other, dataclasses.replace(RUN, run_date=day))
        pages.land_feed(spark, inputs.feed, other, dataclasses.replace(RUN, run_date=day))
    assert landed(one) == landed(other) and landing.read_landing(spark, one).where("txn_id = 'B1'").count() == 2


def test_no_statements(spark, tmp_path):
    assert statements.read_statements(spark, str(tmp_path), RUN).count() == 0


def record(i, day=DAY, **kw):
    base = dict.fromkeys(CANONICAL_COLUMNS) | {
        "txn_id": f"P{i}", "sender_vpa": "a@x", "receiver_vpa": "b@y", "amount": 10.5 + i, "currency": "INR", "status": "SUCCESS",
        "txn_timestamp": f"{day} 10:{i % 60:02d}:00", "ingested_at": f"{day} 23:00:00"}
    return base | kw


def write_pages(folder, records, size=200, skip=()):
    folder.mkdir(parents=True)
    for n, start in enumerate(range(0, len(records), size)):
        if n in skip:
            continue
        part = records[start:start + size]
        more = str(start + size) if start + size < len(records) else None
        (folder / f"page{n}.json").write_text(json.dumps(
            {"records": part, "total": len(records), "count": len(part), "next_cursor": more, "page": n + 1}))


def test_pages(spark, tmp_path):
    rows = [record(i) for i in range(450)] + [record(900, dt.date(2024, 1, 9))]
    write_pages(tmp_path / "whole", rows)
    df = pages.read_feed(spark, str(tmp_path / "whole"), DAY, DAY)
    assert (df.count(), df.select("txn_id").distinct().count()) == (450, 450)
    assert pages.lookup(df, "P7").first().amount == "17.5"
    numbers = df.select("txn_id", F.col("amount").cast("double").alias("amount"))
    page = PageDirectory.build(numbers, ["amount"]).page(400).collect()
    assert [r.txn_id for r in page] == [f"P{i}" for i in range(400, 450)]
    assert [r.txn_id for r in page_after(numbers, ["amount", "txn_id"], (page[0].amount, "P400"), 3).collect()] == ["P401", "P402", "P403"]
    with pytest.raises(ValueError):
        page_after(numbers, ["amount"], (1.0,), limit=501)


def test_missing_page_fails(spark, tmp_path):
    write_pages(tmp_path / "part", [record(i) for i in range(450)], skip={1})
    with pytest.raises(IncompletePull):
        pages.read_feed(spark, str(tmp_path / "part"), DAY, DAY)


def test_raw_rejects(spark):
    text = {c: None for c in CANONICAL_COLUMNS} | {"txn_id": "ok", "amount": "1.005", "txn_timestamp": "2024-01-05 01:02:03"}
    rows = [text, text | {"txn_id": None}, text | {"txn_id": "x" * 37}, text | {"amount": "ten"}, text | {"amount": "99999999999999.5"},
            text | {"txn_timestamp": "soon"}, text | {"currency": "RUPE", "amount": "-"}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in CANONICAL_COLUMNS)).withColumns(
        {"date": F.lit(str(DAY)), "source": F.lit("csv")})
    good = raw_table.accepted(df).collect()
    assert [(r.txn_id, str(r.amount), r.currency, r._source_date) for r in good] == [("ok", "1.01", "INR", DAY)]
    assert sorted(r.reject_reason for r in raw_table.rejects(df).collect()) == [
        "amount not decimal", "amount not decimal", "currency over 3; amount not decimal", "txn_id is null", "txn_id over 36",
        "txn_timestamp not timestamp_ntz"]


@pytest.mark.parametrize("age,state", [(11, "pass"), (13, "warn"), (25, "error")])
def test_freshness(spark, age, state):
    newest = RUN.run_ts - dt.timedelta(hours=age)
    df = spark.createDataFrame([(newest,), (None,)], "ingested_at timestamp_ntz")
    assert freshness(df, RUN).first().freshness == state
    assert freshness(df.limit(0), RUN).first().freshness == "error"


def test_rules(spark):
    assert len(RULES) == 45
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, None), (None, 0)], "k string, n int")
    mine = [Rule("t", "k", "not_null"), Rule("t", "k", "unique"), Rule("t", "n", "assert_positive"), Rule("t", "k", "accepted_values", ("b",), "warn")]
    result = evaluate({"t": df}, RUN, mine)
    assert {r.check_name: r.failures for r in result.collect()} == {"not_null": 2, "unique": 1, "assert_positive": 1, "accepted_values": 2}
    with pytest.raises(QualityError):
        enforce(result)
    enforce(result.where("check_name = 'accepted_values'"))


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "statements"
    folder.mkdir()
    for d in (5, 6):
        day = dt.date(2024, 1, d)
        lines = [",".join(CANONICAL_COLUMNS)]
        for i in range(20):
            lines.append(f"C{d}-{i},U{i},a{i % 3}@x,b@y,{60000 if i == 0 else 100 + i},INR,{'FAILED' if i % 4 else 'SUCCESS'},"
                         f"{day} 03:{i:02d}:00,web,dev,10.0.0.1,pune,,")
        (folder / f"bank_statement_{day}.csv").write_text("\n".join(lines) + "\n")
        # The second day sends a transaction of the first day again, reversed.
        extra = [record(500 + d, day), record(505, day, status="REVERSED")] if d == 6 else [record(500 + d, day)]
        write_pages(tmp_path / "feed" / str(day), extra)
    return daily.Inputs(str(folder), str(tmp_path / "feed"))


def test_daily_run(spark, tmp_path, inputs):
    root = str(tmp_path / "lake")
    at = RUN.run_ts + dt.timedelta(days=1)
    done = daily.run_range(spark, root, inputs, RUN, dt.date(2024, 1, 6), clock=lambda: at)
    first, second = done["2024-01-05"], done["2024-01-06"]
    assert first["loaded_rows"] == 21 and second["loaded_rows"] == 22
    assert (second["raw_upi_transactions"], second["stg_upi_transactions"], second["fct_transactions"]) == (43, 42, 42)
    last = dataclasses.replace(RUN, run_date=dt.date(2024, 1, 6), run_ts=RUN.run_ts + dt.timedelta(days=1))
    tables = daily.Tables(spark, root, last)
    assert tables.path("fct_transactions").endswith("analytics_mart_transaction/fct_transactions")
    moved = tables.read("stg_upi_transactions").where("txn_id = 'P505'").collect()
    assert [(r.status, str(r.txn_date)) for r in moved] == [("REVERSED", "2024-01-06")]
    broken = {(r.relation, r.column_name): r.failures for r in tables.read("dq_results").where("failures > 0 and severity = 'error'").collect()}
    # The transaction sent twice is two raw rows, once per run date that sees them.
    assert broken == {("raw_upi_transactions", "txn_id"): 1}

    def contents(name):
        return sorted(map(repr, tables.read(name).drop("_dbt_invocation_id").collect()))

    names = ("stg_upi_transactions", "snp_customers", "fct_transactions", "fct_fraud_signals", "fct_daily_summary", "raw_upi_transactions")
    before = {n: contents(n) for n in names}
    assert daily.run_date(spark, root, inputs, last) == second
    assert {n: contents(n) for n in names} == before

    # An out-of-order day is loaded but stays out of staging until a full refresh.
    late = dt.date(2024, 1, 2)
    path = tmp_path / "statements" / f"bank_statement_{late}.csv"
    path.write_text(f"txn_id,sender_vpa,receiver_vpa,amount,txn_timestamp\nL1,a@x,b@y,5,{late} 10:00:00\n")
    write_pages(tmp_path / "feed" / str(late), [record(1, late)])
    old = dataclasses.replace(last, run_date=late)
    assert daily.run_date(spark, root, inputs, old, stages=["ingest", "load", "prep"])["stg_upi_transactions"] == 42
    counts = daily.run_date(spark, root, inputs, old, stages=["prep", "marts"], marts=["fct_fraud_signals"], full_refresh=True)
    assert counts["stg_upi_transactions"] == 44


def test_backfill_then_a_normal_run(spark, tmp_path, inputs):
    """Versions of a backfill lie in the past of the run that follows it."""
    root, start = str(tmp_path / "lake"), daily.now()
    stages = ["ingest", "load", "prep", "snapshot"]
    daily.run_range(spark, root, inputs, dataclasses.replace(RUN, run_ts=start), dt.date(2024, 1, 6), stages=stages)
    after = daily.now()
    run = dataclasses.replace(RUN, run_date=dt.date(2024, 1, 6), run_ts=after + dt.timedelta(seconds=1))
    tables = daily.Tables(spark, root, run)
    rows = tables.read("snp_customers").collect()
    assert rows and all(start.replace(microsecond=0) <= r.dbt_valid_from <= after for r in rows)
    extra = tmp_path / "statements" / "more_2024-01-06.csv"
    extra.write_text("txn_id,sender_vpa,receiver_vpa,amount,status,txn_timestamp\nZ1,a1@x,b@y,900000,SUCCESS,2024-01-06 09:00:00\n")
    daily.run_date(spark, root, inputs, run, stages=stages)
    rows = tables.read("snp_customers").collect()
    assert any(r.dbt_valid_to for r in rows) and all(r.dbt_valid_to is None or r.dbt_valid_from < r.dbt_valid_to for r in rows)
    with pytest.raises(ClockWentBack):
        daily.run_date(spark, root, inputs, dataclasses.replace(run, run_ts=start - dt.timedelta(days=1)), stages=["snapshot"])


def test_command_line(spark, tmp_path, inputs, capsys):
    args = ["--root", str(tmp_path / "lake"), "--statements", inputs.statements, "--feed", inputs.feed, "--date", "2024-01-05"]
    daily.main([*args, "--to", "2024-01-06", "--stages", "ingest", "load"])
    lines = capsys.readouterr().out.splitlines()
    assert [line.split()[0] for line in lines] == ["2024-01-05", "2024-01-06"]
    assert "'loaded_rows': 21" in lines[0] and "'raw_upi_transactions': 43" in lines[1]


def test_missing_source_stops_the_run(spark, tmp_path, inputs):
    write_pages(tmp_path / "feed" / "2024-01-07", [record(1, dt.date(2024, 1, 7))])
    run = dataclasses.replace(RUN, run_date=dt.date(2024, 1, 7))
    with pytest.raises(manifest.NotReady):
        daily.run_date(spark, str(tmp_path / "lake"), inputs, run, stages=["ingest"])
    with pytest.raises(ValueError):
        daily.run_date(spark, str(tmp_path / "lake"), inputs, run, marts=["nothing"])
