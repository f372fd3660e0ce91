"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from quire.plans import oracle

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "conversations")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, res.fetchall())
