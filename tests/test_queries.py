"""Every registered query with SQL gives the rows of its SQL, at the smallest scale."""

import math
import os

import duckdb
import pytest

from filigree import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(queries.ORACLES[name])
    place = {c[0]: i for i, c in enumerate(cursor.description)}
    assert sorted(place) == columns
    want = sorted((tuple(norm(r[place[c]]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
