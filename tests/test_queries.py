"""Every registered query against its SQL oracle on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from fieldlens.plans.registry import QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    st = E.queries()[key](spark, SF).toArrow()
    ot = con.sql(E.oracle_sql()[key]).to_arrow_table()
    # same columns with the same types
    assert {f.name: str(f.type) for f in st.schema} == {f.name: str(f.type) for f in ot.schema}
    srows = [tuple(r.values()) for r in st.to_pylist()]
    orows = [tuple(r.values()) for r in ot.to_pylist()]
    assert len(srows) == len(orows)
    assert digest(st.column_names, srows)[0] == digest(ot.column_names, orows)[0]


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.count() > 0
