"""Every registered query equals its SQL counterpart on whole tables."""

import pytest

import __spark_entry__ as entry_point
from tests.oracle_check import duck, rows_of_duck, rows_of_spark
from tierflow.workload.oracle import ORACLE
from tierflow.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    names, rows = rows_of_spark(entry_point.queries()[name](spark, SF_DIR))
    expected_names, expected = rows_of_duck(con, entry_point.oracle_sql()[name])
    assert names == expected_names
    assert expected.total() > 0
    assert rows == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
