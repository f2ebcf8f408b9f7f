"""The registered queries with SQL, against it in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__
from tiffin.llm import queries


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    want = want.select(*[f'"{c}"' for c in columns]).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
