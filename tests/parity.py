"""Row-by-row comparison of a registered query with its SQL twin."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def sql_engine(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _table(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty text if both agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(contract.oracle_sql()[name])
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(set(df.columns) ^ set(rel.columns))}"
    want = _table(rel.columns, rel.fetchall())
    if got == want:
        return ""
    missing, extra = sorted(set(want) - set(got))[:2], sorted(set(got) - set(want))[:2]
    return f"rows {len(got)} vs {len(want)}; columns {sorted(df.columns)}; only SQL {missing}; only Spark {extra}"


def sf_dir(sf: str) -> str:
    return os.path.join(os.environ.get("TESTDATA", "/root/testdata"), f"sf{sf}")
