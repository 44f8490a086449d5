"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from oracle import ORACLE
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(ORACLE) == set(entry._QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry._QUERIES)
def test_matches_sql(spark, con, name):
    good, note = compare(spark, con, SMALL, name)
    assert good, note


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
