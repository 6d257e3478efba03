"""Column names and projections."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three clean-up steps for raw column names, in order.
NAME_STEPS = ((r"\W", "_"), (r"__", "_"), (r"^_|_$", ""))


def normalize_name(name: str) -> str:
    """One clean column name: only word characters, no edge underscores."""
    for pattern, replacement in NAME_STEPS:
        name = re.sub(pattern, replacement, name)
    return name


def normalize_columns(df: DataFrame) -> DataFrame:
    """Clean all column names (names only; no data is touched)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def blanks_to_underscores(df: DataFrame) -> DataFrame:
    """Replace blanks in column names."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; others in the map are ignored."""
    return df.withColumnsRenamed(dict(names))


def ensure_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add string NULL columns for optional source fields the input lacks."""
    known = {c.lower() for c in df.columns}
    absent = {n: F.lit(None).cast("string") for n in names if n.lower() not in known}
    return df.withColumns(absent) if absent else df


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Prefix every column but the kept ones, so joined frames cannot collide."""
    kept = set(keep)
    return df.select(*[F.col(f"`{c}`").alias(c if c in kept else f"{prefix}{c}") for c in df.columns])
