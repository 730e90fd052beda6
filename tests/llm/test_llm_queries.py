"""Text queries with SQL give the same rows in Spark and in DuckDB; the others run."""

import os
from collections import Counter

import pytest

from quire.llm import queries


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{data}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, duck, data, name):
    df = queries.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    plain = lambda row: tuple(round(x, 9) if isinstance(x, float) else x for x in row)
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]}) q")
    assert Counter(map(plain, df.select(*columns).collect())) == Counter(map(plain, cursor.fetchall()))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_others_run(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0
