"""Every query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pytest

from docketry.queries import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    ours = sorted(tuple(plain(v) for v in r) for r in df.select(*cols).collect())
    if name not in registry.ORACLES:
        assert ours
        return
    found = con.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_all_have_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_flagship(spark):
    rows = registry.flagship(spark, SF).collect()
    assert {r["change"] for r in rows} >= {"New", "Unchanged"}
