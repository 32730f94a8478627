"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from tallyflow.plans import log_queries, queries as core, stream_queries

ORACLE, EVERY = core.ORACLE | log_queries.ORACLE | stream_queries.ORACLE, core.queries() | log_queries.queries() | stream_queries.queries()
DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _number(x):
    try:
        return round(float(x), 6)
    except (TypeError, ValueError):
        return str(x)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(EVERY))
def test_same_rows(spark, duck, name):
    df = EVERY[name](spark, DIR)
    names = sorted(df.columns)
    ours = sorted(([_number(r[c]) for c in names] for r in df.collect()), key=repr)
    if name not in ORACLE:
        assert ours
        return
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == names
    at = [rel.columns.index(c) for c in names]
    theirs = sorted(([_number(r[i]) for i in at] for r in rel.fetchall()), key=repr)
    assert ours == theirs
