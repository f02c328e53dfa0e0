"""Every registered query gives the rows of its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_rows_as_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.sql(oracle_sql()[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    ours = in_order(tuple(r) for r in result.select(columns).collect())
    assert ours == in_order(expected.select(*(f'"{c}"' for c in columns)).fetchall())


def test_entry(spark):
    result = entry(spark)
    assert result.columns[0] == "c_custkey"
    assert not result.isEmpty()
