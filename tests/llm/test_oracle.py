"""The queries that SQL can express against their DuckDB SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from quire.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found, want = entry.queries()[name](spark, SF), con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(cols)
    assert Counter(tuple(r) for r in found.select(*cols).collect()) == Counter(want.fetchall())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op11_spelling"}))
def test_one_row_for_each_input_row(spark, name):
    found = entry.queries()[name](spark, SF)
    if name == "op2_packing":
        found = found.where("piece = 0")
    if name == "op12_curve_packing":
        found = found.where("start = 0")
    table = {"op7_urls": "pages", "op13_vector_codes": "embeddings"}.get(name, "documents")
    assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
