"""Queries with an SQL counterpart equal it on whole tables."""

import duckdb
import pytest

from tests.oracle_check import rows_of_duck, rows_of_spark
from tierflow.llm.oracle import ORACLE
from tierflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    names, rows = rows_of_spark(QUERIES[name](spark, SF_DIR))
    expected_names, expected = rows_of_duck(con, ORACLE[name])
    assert names == expected_names
    assert expected.total() > 0
    assert rows == expected
