"""Queries with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from txnlake.llm.oracles import ORACLE
from txnlake.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = connection.execute(ORACLE[name])
    names = [one[0] for one in result.description]
    found = QUERIES[name](spark, folder)
    assert sorted(names) == sorted(found.columns) and dict(found.dtypes).keys() == set(names)
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(row)) for row in found.select(*names).collect()) == expected
