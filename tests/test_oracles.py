"""Every registered query against its SQL twin."""

import os
import re

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, duckdb_rows, kinds, spark_rows
from txflow.plans.catalogue import catalogue
from txflow.plans.oracles import oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalogue()
ORACLES = oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, rows = spark_rows(df)
    expected_columns, expected = duckdb_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert kinds(rows) == kinds(expected)
    assert rows
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas|LocalTableScan", plan)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert ORACLES.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
