"""Mapped views and the query registry.

A view is one SQL text both engines run: Spark with frames for the {names},
the oracle with common table expressions. Views carry natural keys rather
than row numbers, so no engine has to number a whole table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.session import file_states
from fieldstar.sources.text import spread

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

VIEWS: dict[str, str] = {}
# Views that stand for an unsplittable raw file: the table behind them is redistributed, unless its scan is dealt evenly.
SPREAD = {"split_docs": "documents"} | {
    name: "lineitem" for name in ("raw_obs", "bands", "nests", "nest_rows", "july_rows", "band_rows", "route_counts")
}
PIECE_BYTES = 8 << 20  # of Parquet: about half a million rows of the widest table
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def names_in(sql: str) -> list[str]:
    """The {names} of a template, each once."""
    return list(dict.fromkeys(n for _, n, _, _ in Formatter().parse(sql) if n))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(df: DataFrame, parts: int = 1) -> int:
    """Tasks or files that each of `parts` takes, so that none grows with the input: 1 for a small one."""
    size = sum(length for _, length, _ in file_states(df.sparkSession, df.inputFiles()))
    return max(1, math.ceil(size / (PIECE_BYTES * parts)))


def well_split(df: DataFrame, tasks: int) -> bool:
    """Whether a table's scan gives that many tasks rows, and none more than twice its share: no column is read for it."""
    rows = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    return len(rows) >= tasks and max(rows) * len(rows) <= 2 * sum(rows)


def shuffled(df: DataFrame) -> bool:
    """Whether a frame's plan deals rows anew by itself; broadcasts do not."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mapped view (or base table) as a frame."""
    if name in BASE:
        return table(spark, sf_dir, name)
    sql = VIEWS[name]
    frames = {n: view(spark, sf_dir, n) for n in names_in(sql)}
    if name in SPREAD:
        raw = frames[SPREAD[name]]
        if not well_split(raw, spark.sparkContext.defaultParallelism):
            frames[SPREAD[name]] = spread(raw, max(spark.sparkContext.defaultParallelism, pieces(raw)))
    return spark.sql(sql, **frames)


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in names_in(sql):
        if name in VIEWS and name not in found:
            _needed(VIEWS[name], found)
            found.append(name)
    return found


def oracle(sql: str) -> str:
    """Oracle text: the views it needs as common table expressions, then the query."""
    spell = {n: n for n in BASE} | {n: f"v_{n}" for n in VIEWS}
    needed = _needed(sql, [])
    body = sql.format(**spell)
    if not needed:
        return body
    ctes = ", ".join(f"v_{n} AS ({VIEWS[n].format(**spell)})" for n in needed)
    return f"WITH {ctes} SELECT * FROM ({body}) AS answer"


def query(name: str, sql: str | None = None):
    """Register a driver query under a name, with its oracle text if it has one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return function

    return register
