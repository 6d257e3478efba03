"""Grouped reductions; all of them combine on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.functions.numbers import to_num
from fieldstar.functions.text import present
from fieldstar.functions.times import hhm_to_hhmm
from fieldstar.operators.joins import lookup, semi_known


def first_nonempty(c: Column, order: Sequence[str]) -> Column:
    """Aggregate: the first value, by order, that is neither NULL nor ''; else ''."""
    rank = F.when(present(c), F.struct(*order))
    return F.coalesce(F.min_by(c, rank), F.lit(""))


def first_present(c: Column, order: Sequence[str]) -> Column:
    """Aggregate: the first non-NULL value by order."""
    return F.min_by(c, F.when(c.isNotNull(), F.struct(*order)))


def collapse_attempts(
    df: DataFrame,
    key: str,
    maxes: Iterable[str],
    firsts: Iterable[str],
    order: Sequence[str],
    dates: Iterable[str] = (),
) -> DataFrame:
    """One row per attempt: numeric maxima, first non-empty texts, first dates."""
    return df.groupBy(key).agg(
        *[F.max(to_num(F.col(c))).alias(c) for c in maxes],
        *[first_present(F.col(c), order).alias(c) for c in dates],
        *[first_nonempty(F.col(c), order).alias(c) for c in firsts],
    )


def effort_events(bands: DataFrame, effort: DataFrame, stations: DataFrame, places: DataFrame) -> DataFrame:
    """One event per (station, net, date) of the bands, with effort's times.

    Both sides are reduced to the key before they meet (min and max do not
    care), so the join is one-to-one and a busy net never fans out.
    """
    key = ["STA", "NET", "DATE"]
    banded = bands.groupBy(*key).agg(F.max("STATION").alias("STATION"))
    hours = effort.groupBy(*key).agg(
        F.min(hhm_to_hhmm(F.col("START"))).alias("started"),
        F.max(hhm_to_hhmm(F.col("END"))).alias("ended"),
        F.max("LENGTH").alias("LENGTH"),
    )
    kept = semi_known(stations, places, "place_id").groupBy("STA").agg(F.max("place_id").alias("place_id"))
    located = lookup(banded, kept, "STA", ["place_id"], how="inner")
    midnight = hhm_to_hhmm(F.lit(None).cast("string"))
    return located.join(hours, key, "left").withColumns(
        {
            "started": F.coalesce("started", midnight),
            "ended": F.coalesce("ended", midnight),
            "NET": F.coalesce("NET", F.lit("?")),
        }
    )


def counts_by(df: DataFrame, name: str, targets: DataFrame, out: str = "n") -> DataFrame:
    """Row count for every target name, zero where there is none."""
    seen = df.groupBy(name).agg(F.count("*").alias(out))
    wanted = targets.select(name).distinct()
    return wanted.join(seen, name, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))

