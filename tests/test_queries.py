"""Registered queries on the given tables; the trajectory queries are compared with
SQL in test_skew.py, on harder data."""

import pytest
from oracle import SMALL, connect, differences

import __spark_entry__ as entry
from fleetlife_entry.queries import REGISTRY

QUERIES = entry.queries()
SQL = entry.oracle_sql()
# Queries on tables other than events.
UNSKEWED = ["cycle_violations", "cycle_profile"]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["telemetry", "temporal_features", "metrics", "split_validation", *UNSKEWED])
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() == 4
