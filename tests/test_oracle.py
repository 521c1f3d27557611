"""Every registered query against its SQL statement, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
from txnlake.plans.queries import QUERIES as REGISTERED

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = {name: query for name, query in entry_point.queries().items() if name in REGISTERED}
ORACLE = {name: sql for name, sql in entry_point.oracle_sql().items() if name in REGISTERED}
# Run times have no SQL form; test_ingest covers them.
ROWS_ONLY = {"run_summary"}
# Ninety days of a tiny table have no country with fifty rows.
MAY_BE_EMPTY = {"a07_country_failures"}


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    yield connection
    connection.close()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_query_has_sql_or_is_known_not_to():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    df = QUERIES[name](spark, folder)
    rows = df.collect()
    assert rows or name in MAY_BE_EMPTY
    if name in ORACLE:
        result = database.execute(ORACLE[name])
        names = [d[0] for d in result.description]
        assert canonical(df.columns, rows) == canonical(names, result.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 30
