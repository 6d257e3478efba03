"""Identity: first row per key, duplicate masks, surrogate ids, dense codes.

"First" always means first by an explicit, total row order; partition or file
arrival order is never relied upon. `order` columns must not tie within a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstar.session import stage

# Order columns that `sources.text.with_row_order` adds to file scans.
FILE_ORDER = ("_file", "_block", "_row")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One whole row per key: the first by `order` (or the last).

    Spark limits the window group before the shuffle as well as after it, so
    a map task sends at most one row per key and a hot key stays harmless.
    """
    ranked = [F.col(f"`{c}`").desc() if last else F.col(f"`{c}`").asc() for c in order]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*ranked)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def is_duplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "is_duplicate") -> DataFrame:
    """Flag every row of a key but its first.

    The winners are found with early reduction and then matched on key and
    order together, which spreads even one huge key over all tasks.
    """
    columns = list(dict.fromkeys([*keys, *order]))
    firsts = first_per_key(df.select(*columns), keys, order)
    firsts = firsts.select(*[F.col(c).alias(f"_first_{c}") for c in columns], F.lit(False).alias(out))
    same = [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in columns]
    joined = df.join(firsts, same, "left").drop(*[f"_first_{c}" for c in columns])
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(True)))


def first_seen(batch: DataFrame, seen: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key of a batch, for keys no earlier batch has brought."""
    return first_per_key(batch, keys, order).join(seen.select(*keys), list(keys), "left_anti")


def next_id(df: DataFrame, col: str) -> int:
    """One past the largest id; 1 for an empty table."""
    return df.agg(F.coalesce(F.max(col), F.lit(0))).first()[0] + 1


_IN_PARTITION = (1 << 33) - 1


def _placed(df: DataFrame) -> DataFrame:
    """The rows written down with their partition and place in it: what runs again finds the same places."""
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    return stage(df.withColumns({"_part": F.spark_partition_id(), "_place": in_partition}), "ids")


def assign_ids(df: DataFrame, col: str, start: int, order: Sequence[str]) -> DataFrame:
    """Contiguous ids `start, start+1, ...` in the given order.

    Rows in file order that come straight from a scan are numbered where they
    are (see `assign_ids_in_place`). Others are range-partitioned and sorted by
    the order, staged with their place in the partition, and shifted by the
    sizes of the partitions before theirs: no step sorts or numbers everything
    in one task. The offsets table has one row per partition, which bounds the
    broadcast. Staging fixes the ids: a task run again reads the same places.
    """
    if tuple(order) == FILE_ORDER and in_file_order(df):
        return assign_ids_in_place(df, col, start)
    by = [F.col(f"`{c}`") for c in order]
    placed = _placed(df.repartitionByRange(*by).sortWithinPartitions(*by))
    sizes = placed.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("count").over(before), F.lit(0)) + F.lit(start)
    offsets = sizes.select("_part", offset.alias("_offset"))
    return _shifted(placed.join(F.broadcast(offsets), "_part"), col).drop("_part", "_place", "_offset")


def meet_offsets(df: DataFrame, offsets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with their split's offsets, one row per split: no row is moved for it."""
    return df.join(F.broadcast(offsets), list(on))


def _shifted(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, (F.col("_offset") + F.col("_place")).cast("long"))


def in_file_order(df: DataFrame) -> bool:
    """Whether a frame's rows still stand as their files were read: nothing below it shuffles or sorts them.

    Joins with a broadcast side keep the order of the other side's rows.
    """
    plan = df._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    moved = ("Exchange", "Sort", "Coalesce", "CartesianProduct", "NestedLoopJoin")
    return "FileScan" in plan and not any(word in plan for word in moved)


def assign_ids_in_place(df: DataFrame, col: str, start: int) -> DataFrame:
    """Contiguous ids in file order (`FILE_ORDER`) for rows that stand in it, without moving them.

    A task reads its splits one after the other, so a split's rows are a run of
    places in one partition. Their number shifts the splits after it: what is
    sorted and broadcast is one row per split and partition, not per row. A
    frame whose splits turn out not to be such runs is refused.
    """
    placed = _placed(df)
    name = F.xxhash64("_part", "_file", "_block")
    runs = placed.groupBy("_part", "_file", "_block").agg(
        F.count("*").alias("_n"),
        F.min("_place").alias("_from"),
        F.max("_place").alias("_to"),
        F.min("_row").alias("_first"),
        F.max("_row").alias("_last"),
        F.min_by("_row", "_place").alias("_opens"),
        F.max_by("_row", "_place").alias("_ends"),
    )
    runs = stage(runs.withColumn("_run", name), "id-runs")
    whole = (F.col("_to") - F.col("_from") + 1 == F.col("_n")) & F.col("_first").eqNullSafe(F.col("_opens"))
    whole &= F.col("_last").eqNullSafe(F.col("_ends"))
    check = runs.agg(F.count("*"), F.count_distinct("_run"), F.count_if(~whole)).first()
    if check[0] != check[1] or check[2]:
        raise ValueError("rows do not stand in file order")
    before = Window.orderBy("_file", "_block", "_first").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start) - F.col("_from")
    offsets = runs.select(F.col("_run").alias("_of"), offset.alias("_offset"))
    met = placed.withColumn("_run", name).join(F.broadcast(offsets), F.col("_run") == F.col("_of"))
    return _shifted(met, col).drop("_part", "_place", "_offset", "_run", "_of")


def factorize(df: DataFrame, key: str, out: str, order: Sequence[str], start: int = 0) -> DataFrame:
    """Dense code per distinct key, numbered by first appearance."""
    order = [c for c in order if c != key]
    firsts = first_per_key(df.select(key, *order), [key], [*order, key])
    codes = assign_ids(firsts, out, start, [*order, key]).select(F.col(key).alias("_key"), out)
    return df.join(codes, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return the frame, or raise naming a few repeated keys."""
    repeated = duplicate_keys(df, keys).take(5)
    if repeated:
        raise ValueError(f"{list(keys)} not unique, for example {[tuple(r) for r in repeated]}")
    return df
