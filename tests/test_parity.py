"""Every registered query against its SQL twin, and the hot-key plans against the same twins."""

import dataclasses

import parity
import pytest

import __spark_entry__ as contract
from paylake import queries as registered
from paylake.config import Settings, SkewPolicy

SF = parity.sf_dir("0.001")


@pytest.fixture(scope="module")
def con():
    return parity.sql_engine(SF)


def test_every_query_has_a_twin():
    assert set(registered.queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, con, name):
    assert parity.compare(spark, con, name, SF) == ""


@pytest.mark.parametrize("min_rows", [3, 300])
@pytest.mark.parametrize(
    "name", ["int_transactions_enriched", "fct_fraud_signals", "fct_daily_summary", "fct_transactions", "fct_fraud_summary"])
def test_query_with_hot_keys(spark, con, monkeypatch, name, min_rows):
    hot = Settings(skew=SkewPolicy(min_rows=min_rows, max_keys=1000))
    monkeypatch.setattr(registered, "RUN", dataclasses.replace(registered.RUN, settings=hot))
    assert parity.compare(spark, con, name, SF) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["txn_date", "signal_type"]
