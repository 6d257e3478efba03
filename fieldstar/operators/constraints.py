"""Declared rules checked over whole tables, reported as violation rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.operators.joins import anti_new
from fieldstar.operators.keys import duplicate_keys
from fieldstar.schema import RULES


def violation_rows(df: DataFrame, table: str, rule: str, column: str, key, n) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        key.cast("string").alias("key"),
        n.cast("long").alias("n"),
    )


def null_violations(df: DataFrame, table: str) -> DataFrame:
    """Number of NULLs per column that must have none (one pass per table)."""
    rules = RULES[table]
    columns = [c for c in dict.fromkeys([rules.primary, *rules.not_null]) if c in df.columns]
    totals = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").alias("n")) for c in columns])
    long = totals.select(F.inline(rows)).filter(F.col("n") > 0)
    return long.select(
        F.lit(table).alias("table_name"),
        F.lit("not null").alias("rule"),
        F.col("c").alias("column_name"),
        F.lit(None).cast("string").alias("key"),
        F.col("n").cast("long").alias("n"),
    )


def unique_violations(df: DataFrame, table: str) -> DataFrame | None:
    """Repeated primary or unique keys with their row counts; None without such columns."""
    rules = RULES[table]
    columns = [c for c in dict.fromkeys([rules.primary, *rules.unique]) if c in df.columns]
    found = [
        violation_rows(duplicate_keys(df.dropna(subset=[c]), [c]), table, "unique", c, F.col(f"`{c}`"), F.col("n"))
        for c in columns
    ]
    return reduce(DataFrame.unionByName, found) if found else None


def fk_violations(df: DataFrame, table: str, tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Orphan key values with their row counts; None without foreign keys to check.

    Values are counted before the anti-join, so each meets the parent once.
    """
    found = []
    for column, parent in RULES[table].foreign.items():
        if parent not in tables or column not in df.columns:
            continue
        values = df.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n"))
        orphans = anti_new(values, tables[parent], {column: RULES[parent].primary})
        found.append(violation_rows(orphans, table, f"references {parent}", column, F.col(column), F.col("n")))
    return reduce(DataFrame.unionByName, found) if found else None


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All violations of all given tables; an empty result means they hold."""
    found = []
    for name, df in tables.items():
        found += [null_violations(df, name), unique_violations(df, name), fk_violations(df, name, tables)]
    return reduce(DataFrame.unionByName, [f for f in found if f is not None])


def split_by_rules(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that have all their required columns, rows that lack some with a `reason`)."""
    required = RULES[table].not_null
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    checked = df.withColumn("reason", F.array_join(lacking, ", "))
    return checked.filter("reason = ''").drop("reason"), checked.filter("reason <> ''")


def split_orphans(df: DataFrame, table: str, lost: DataFrame, column: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rows whose parent is among the `lost` ids with a `reason`); no parent is no reason."""
    keys = lost.select(F.col(column).alias("_lost")).distinct()
    same = F.col(column) == F.col("_lost")
    kept = df.join(keys, same, "left_anti")
    return kept, df.join(keys, same, "left_semi").withColumn("reason", F.lit(f"{parent} was rejected"))
