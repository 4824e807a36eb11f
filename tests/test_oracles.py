"""Every catalogue query against its SQL, on the smallest tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


# no airport appears in both of the two newest snapshots of the smallest tables
MAY_BE_EMPTY = {"snapshot_delta"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    outcome = compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert outcome is None or (outcome == "no rows" and name in MAY_BE_EMPTY)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert "traffic_1h" in rows.columns and rows.count() > 0
