"""Registered queries with SQL agree with DuckDB on the whole tables."""

import glob
import os

import duckdb
import pytest

from ledgerfold.llm.oracle import ORACLE
from ledgerfold.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.plain import near

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "array<int>": "INTEGER[]",
         "array<string>": "VARCHAR[]"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in cur.description}
    cols = sorted(df.columns)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    order = [list(types).index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    assert all(near(x, y) if isinstance(x, float) and isinstance(y, float) else x == y for g, w in zip(got, want) for x, y in zip(g, w))
