"""Queries with a SQL equivalent give its rows on whole tables."""

import os

import duckdb
import pytest

from dyadlake.llm import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = registry.queries()[name](spark, DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(want.fetchall())
