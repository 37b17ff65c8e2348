"""Every query with a SQL equivalent gives the rows that the SQL gives."""

import math
import os

import duckdb
import pytest

from dyadlake.plans import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{name}'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 5) if isinstance(v, float) else v
    return sorted(names), sorted((tuple(fix(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sql, name):
    df = registry.queries()[name](spark, DIR)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.oracle_sql():
        assert got[1]
        return
    want = sql.execute(registry.oracle_sql()[name])
    want = rows([c[0] for c in want.description], want.fetchall())
    assert got == want
