"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import connect, duck_result, spark_result
from sparkloom.plans import catalog, oracles

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()
ENTRY_ORACLES = {k: x for k, x in entry_module.oracle_sql().items() if k not in ORACLES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_same_keys():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, duck, key):
    columns, rows = spark_result(QUERIES[key](spark, SF_DIR))
    expected_columns, expected = duck_result(duck, ORACLES[key])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows or key == "flag_impact_top"


@pytest.mark.parametrize("key", sorted(ENTRY_ORACLES))
def test_entry_matches_sql(spark, duck, key):
    columns, rows = spark_result(entry_module.queries()[key](spark, SF_DIR))
    expected_columns, expected = duck_result(duck, ENTRY_ORACLES[key])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
