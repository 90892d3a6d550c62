"""Registered queries against their DuckDB oracles (small scale) and the
driver smoke entry."""

import pytest

import __spark_entry__ as E
from tickwise.plans.registry import all_oracles, all_queries
from tests.compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
BATCH = [k for k in all_queries() if not k.startswith("stream_")]
STREAM = [k for k in all_queries() if k.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["stock_ticker", "timestamp", "price"]
    assert df.count() > 0


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_oracle(spark, con, name):
    rep = compare(all_queries()[name](spark, SF), con, all_oracles()[name])
    assert rep["ok"], rep


@pytest.mark.parametrize("name", STREAM)
def test_stream_query_matches_oracle(spark, con, name):
    rep = compare(all_queries()[name](spark, SF), con, all_oracles()[name])
    assert rep["ok"], rep
