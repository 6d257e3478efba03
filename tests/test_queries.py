"""Every driver query against its oracle on the smallest test tables."""

import os

import pytest

from checks.all_queries import ORACLES, QUERIES
from checks.compare import oracle_rows, plain
from checks.registry import BASE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    df = df.select(*[f"`{n}`" for n in names])
    rows = sorted(tuple(plain(v) for v in row) for row in df.collect())
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name in ORACLES:
        assert (names, rows) == oracle_rows(oracle, ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
