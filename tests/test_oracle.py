"""Every registered query against its DuckDB SQL on the sf0.001 tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_DIR)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    got = sorted(repr(tuple(_norm(x) for x in r)) for r in sdf.collect())
    want = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rel.fetchall())
    assert got == want
    assert spark._jsc.getPersistentRDDs().size() == 0          # nothing stays cached


def test_rows_only_queries_run(spark):
    for name in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[name](spark, SF_DIR).count() >= 0
