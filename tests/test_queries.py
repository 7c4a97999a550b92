"""Every registered query against its SQL, run by DuckDB on the same tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tapeworks.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (decimal.Decimal, float)) and not isinstance(value, bool):
        return format(decimal.Decimal(repr(value) if isinstance(value, float) else value).normalize() + 0, "f")
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(relation.columns)
    assert as_rows(result.columns, result.collect()) == as_rows(relation.columns, relation.fetchall())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r.messages for r in rows) > 0
