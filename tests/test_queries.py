"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import os
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from quire.plans import layout, nested, quality, records

CORE_SQL = {k: v for m in (quality, layout, records, nested) for k, v in m.SQL.items()}
CORE = {k: v for m in (quality, layout, records, nested) for k, v in m.QUERIES.items()}


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if hasattr(v, "asDict"):
        v = v.asDict(True)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    return v


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{data}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(CORE_SQL))
def test_same_as_sql(spark, duck, data, name):
    df = CORE[name](spark, data)
    columns = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    cursor = duck.execute(CORE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(CORE) - set(CORE_SQL)))
def test_others_run(spark, data, name):
    assert CORE[name](spark, data).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
