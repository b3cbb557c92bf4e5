"""The operators' queries with a SQL twin against it."""

import os

import pytest

from fieldlens.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, key):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got, want = queries.QUERIES[key](spark, SF).toArrow(), con.sql(queries.SQL[key]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    names = sorted(got.column_names)
    assert sorted(map(repr, got.select(names).to_pylist())) == sorted(map(repr, want.select(names).to_pylist()))
