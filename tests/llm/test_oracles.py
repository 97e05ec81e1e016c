"""Corpus queries against their reference SQL."""

import duckdb
import pytest

from dockflow.llm import queries


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op4_ngram_jaccard", "op9_suffix_dedup"])
def test_query_equals_sql(spark, name):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for table in ("conversations", "documents"):
        c.sql(f"create view {table} as select * from '{d}/{table}.parquet'")
    got = queries.QUERIES[name](spark, d).toPandas()
    want = c.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.astype(str).to_numpy().tolist())) == sorted(map(tuple, want[list(got.columns)].astype(str).to_numpy().tolist()))
