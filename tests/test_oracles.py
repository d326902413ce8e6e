"""Every registered query runs on driver tables; those with SQL agree with it row by row."""

import math
from collections import Counter

import duckdb
import pytest

from tidemark.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, sf, name):
    got = catalog.queries()[name](spark, sf)
    columns = sorted(got.columns)
    rows = [tuple(plain(v) for v in r) for r in got.select(*columns).collect()]
    if name not in SQL:
        assert rows
        return
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    want = [tuple(plain(v) for v in r) for r in want.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()]
    a, b = Counter(rows), Counter(want)
    assert a == b, (len(rows), len(want), list((a - b).items())[:3], list((b - a).items())[:3])
    assert rows
