"""Every query of the text operators that has SQL against it, on the smallest test tables."""

import os

import pytest

from checks.compare import oracle_rows, plain
from checks.registry import BASE
from fieldstar.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in BASE:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    rows = sorted(tuple(plain(v) for v in row) for row in df.select(*names).collect())
    assert (names, rows) == oracle_rows(con, ORACLES[name])
