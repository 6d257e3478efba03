"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with its oracle text if SQL can express it."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` refers to it.

    The optimizer inlines a projected expression wherever it is used, also
    into lambdas, where it would be computed anew for every element; a lambda
    variable cannot be inlined.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def held_out(id_col: str, folds: int) -> Column:
    """Whether a row's id falls into the fold that no model learns from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0
