"""The parts of the operators that SQL can state, against DuckDB."""

import os

import duckdb
import pytest

from tallyflow.llm import queries as llm

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for f in os.listdir(DIR):
        duck.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    df = llm.queries()[name](spark, DIR)
    names = sorted(df.columns)
    rel = duck.sql(llm.oracle_sql()[name])
    assert sorted(rel.columns) == names
    at = [rel.columns.index(c) for c in names]
    assert sorted(([r[c] for c in names] for r in df.collect()), key=repr) == sorted(([r[i] for i in at] for r in rel.fetchall()), key=repr)
