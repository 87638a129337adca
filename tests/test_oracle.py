"""Every registered query with SQL agrees with DuckDB on the whole tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_registered_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cur.description}
    cols = sorted(df.columns)
    assert sorted(types) == cols
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    order = [list(types).index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    assert all(near(x, y) for g, w in zip(got, want) for x, y in zip(g, w))
