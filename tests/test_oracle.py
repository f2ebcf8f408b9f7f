"""Every query of the delivery tables against its SQL in DuckDB, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__
from tests.conftest import SF_DIR
from tiffin.testbed import oracle, registry

QUERIES = registry.queries()
SQL = {name: __spark_entry__.oracle_sql()[name] for name in QUERIES}
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def text(records):
    return sorted(tuple(repr(v) for v in r) for r in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    kinds = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert kinds == dict(zip(want.columns, map(str, want.types)))
    want = want.select(*[f'"{c}"' for c in columns]).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert text(got) == text(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 24
