"""Run queries in Spark and their oracle text in DuckDB and compare the rows.

Usage: python -m checks.compare SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.all_queries import ORACLES, QUERIES
from checks.registry import BASE
from fieldstar.session import get_session


def plain(value):
    """A value as comparable text; floats to nine digits."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def oracle_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    index = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(plain(row[i]) for i in index) for row in result.fetchall())
    return [names[i] for i in index], rows


def session(cores: str = "8"):
    return get_session(
        "checks",
        **{
            "spark.master": f"local[{cores}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )


def main(argv: list[str]) -> int:
    sf_dir, wanted = argv[0], argv[1:] or list(QUERIES)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
            took = time.time() - began
            if name not in ORACLES:
                print(f"rows-only {name}: {len(rows)} rows {took:.2f}s", flush=True)
                continue
            names, expected = oracle_rows(con, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:700]}", flush=True)
            continue
        same = columns == names and rows == expected
        bad += not same
        print(f"{'ok' if same else 'DIFF'} {name}: {len(rows)}/{len(expected)} rows {took:.2f}s", flush=True)
        if not same:
            print("   ", columns, names)
            ours, theirs = set(rows), set(expected)
            print("    spark only ", sorted(ours - theirs)[:3])
            print("    oracle only", sorted(theirs - ours)[:3])
    print(f"{len(wanted)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
