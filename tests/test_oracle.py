"""Every registered query against its DuckDB SQL formulation (smallest scale)."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from encore.catalog import QUERIES
from encore.oracle import ORACLE

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test data not present")


def _canon(rows):
    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ROOT}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, ROOT)
    cols = sorted(df.columns)
    got = _canon(tuple(r) for r in df.select(*cols).collect())
    sql = oracle_sql()[name]
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    exp = _canon(con.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall())
    assert got == exp


def test_entry_runs(spark):
    df = entry(spark)
    assert set(df.columns) == {"customerid", "rnk", "artistid", "n"}
    assert df.count() > 0
