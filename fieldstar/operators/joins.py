"""Lookups, existence tests and bridges between code systems.

Dimensions are never hinted into a broadcast: the optimizer broadcasts a side
whose measured size is below the session's threshold and otherwise shuffles,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.functions.jsonblob import blob_value
from fieldstar.functions.text import zfill
from fieldstar.operators.keys import assert_unique, first_per_key

On = str | Sequence[str] | Mapping[str, str]


def _pairs(on: On) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: On,
    take: Iterable[str] | Mapping[str, str],
    how: str = "left",
    checked: bool = False,
) -> DataFrame:
    """Bring columns of a key-unique table to every row; no match gives NULL.

    `on` maps left to right key columns, `take` maps the dimension's columns to
    output names. An existing column of that name is replaced. `checked` counts
    the dimension's keys first and raises if one repeats.
    """
    on = _pairs(on)
    if checked:
        assert_unique(dim, list(on.values()))
    take = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    keys = {left: f"_key_{i}" for i, left in enumerate(on)}
    right = dim.select(
        *[F.col(f"`{r}`").alias(keys[left]) for left, r in on.items()],
        *[F.col(f"`{c}`").alias(f"_take_{out}") for c, out in take.items()],
    )
    condition = [F.col(f"`{left}`") == F.col(key) for left, key in keys.items()]
    joined = df.join(right, condition, how).drop(*keys.values())
    for out in take.values():
        joined = joined.drop(out).withColumnRenamed(f"_take_{out}", out)
    return joined


def semi_known(df: DataFrame, ref: DataFrame, on: On) -> DataFrame:
    """Rows whose key occurs in the reference table."""
    return _exists(df, ref, on, "left_semi")


def anti_new(df: DataFrame, ref: DataFrame, on: On) -> DataFrame:
    """Rows whose key does not occur in the reference table."""
    return _exists(df, ref, on, "left_anti")


def _exists(df: DataFrame, ref: DataFrame, on: On, how: str) -> DataFrame:
    on = _pairs(on)
    keys = {left: f"_key_{i}" for i, left in enumerate(on)}
    right = ref.select(*[F.col(f"`{r}`").alias(keys[left]) for left, r in on.items()])
    return df.join(right, [F.col(f"`{left}`") == F.col(key) for left, key in keys.items()], how)


def drop_known(df: DataFrame, taxa: DataFrame, order: Sequence[str], key: str = "sci_name") -> DataFrame:
    """First row per name, for names the taxonomy does not have yet."""
    return first_per_key(anti_new(df, taxa, key), [key], order)


def flag_members(df: DataFrame, ref: DataFrame, on: On, out: str) -> DataFrame:
    """Add a flag telling whether the row's key occurs in the reference table."""
    pairs = _pairs(on)
    members = ref.select(*[F.col(f"`{r}`") for r in pairs.values()]).distinct().withColumn(out, F.lit(True))
    return lookup(df, members, pairs, [out]).withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def missing_codes(df: DataFrame, ref: DataFrame, key: str, null_aware: bool = False) -> DataFrame:
    """Rows whose code the reference table lacks.

    With `null_aware`, SQL's NOT IN: nothing passes once the reference holds a
    NULL, and a row without a code passes only against an empty reference. The
    NULL test is one scalar; the reference itself is joined by hash, not
    broadcast as Spark's own null-aware anti join would do.
    """
    missing = anti_new(df, ref, key)
    if not null_aware:
        return missing
    rows = ref.agg(F.count("*")).scalar()
    nulls = ref.agg(F.count_if(F.col(key).isNull())).scalar()
    return missing.filter((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def json_key_join(left: DataFrame, right: DataFrame, blob: str, keys: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join on keys stored in the right side's blob: {left column: JSON key}.

    The keys are the columns kept beside the blob, or become columns first, so
    the join is a plain equi-join.
    """
    names = {left_col: f"_json_{i}" for i, left_col in enumerate(keys)}
    extracted = right.withColumns({names[c]: blob_value(right, blob, k) for c, k in keys.items()})
    condition = [F.col(f"own.{c}").cast("string") == F.col(n) for c, n in names.items()]
    return left.alias("own").join(extracted, condition, how).drop(*names.values())


def code_bridge(
    codes: DataFrame,
    taxa: DataFrame,
    code: str = "species_id",
    name: str = "sci_name",
    width: int = 4,
    order: Sequence[str] = (),
) -> DataFrame:
    """(code, taxon_id) for codes whose scientific name is in the taxonomy.

    With the list's `order` a code that stands in it twice means the last one;
    without, all its taxa come out.
    """
    known = codes.filter(F.col(name).isNotNull()).select(name, zfill(F.col(code), width).alias(code), *order)
    met = known.join(taxa.select(name, "taxon_id"), name)
    if order:
        met = first_per_key(met, [code], order, last=True)
    return met.select(code, "taxon_id").distinct()


def backfill_scalar(df: DataFrame, dim: DataFrame, on: On, take: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Fill columns from the first matching row; repeated keys cannot multiply rows."""
    return lookup(df, first_per_key(dim, list(_pairs(on).values()), order), on, take)
