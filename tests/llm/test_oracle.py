"""Queries that SQL can express, against DuckDB on the smallest tables."""

import pytest

from compare import connect, duckdb_result, spark_result
from turnmill.llm.oracle import ORACLE
from turnmill.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, small):
    assert spark_result(QUERIES[name](spark, small)) == duckdb_result(connect(small), ORACLE[name])
