"""Wide rows to long: event rows from dates, count rows from measures, star split."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import assign_ids, first_per_key
from fieldstar.schema import ID_COLUMNS, SCHEMAS


def _long(df: DataFrame, rows: Iterable[Column], keep: Iterable[str]) -> DataFrame:
    kept = [F.col(f"`{c}`") for c in keep]
    return df.select(*kept, F.inline(F.array(*rows)))


def melt_events(
    df: DataFrame, dates: Mapping[str, str], keep: Iterable[str] | None = None, date: str = "date"
) -> DataFrame:
    """One row per present date column, tagged with its event type.

    Expands in place: no shuffle, and every input column can be kept.
    """
    keep = list(df.columns if keep is None else keep)
    rows = [
        F.struct(F.lit(kind).alias("event_type"), F.lit(i).alias("event_rank"), F.col(c).alias(date))
        for i, (kind, c) in enumerate(dates.items())
    ]
    return _long(df, rows, keep).filter(F.col(date).isNotNull())


def melt_counts(
    events: DataFrame, measures: Mapping[str, str], keep: Iterable[str], out: str = "count"
) -> DataFrame:
    """One row per present measure that belongs to the event's type.

    `measures` maps measure column to event type. The events carry the measure
    columns, so tying a count to its event needs no join. A measure that no
    int holds gives a NULL count, which no table takes: it becomes a reject.
    """

    def row(rank: int, measure: str, kind: str) -> Column:
        value = F.when(F.col("event_type") == kind, F.col(measure))
        return F.struct(
            F.lit(measure).alias("count_type"),
            F.lit(rank).alias("count_rank"),
            value.try_cast("int").alias(out),
            value.isNotNull().alias("_present"),
        )

    rows = [row(i, measure, kind) for i, (measure, kind) in enumerate(measures.items())]
    return _long(events, rows, [*keep, "event_type"]).filter("_present").drop("_present")


def number_rows(
    df: DataFrame,
    key: Sequence[str] | None,
    col: str,
    start: int,
    order: Sequence[str],
    shape: Callable[[DataFrame], DataFrame] | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of one level of the star, shaped and numbered: the first per key, or all.

    Shaping (blobs, coercions) runs after the reduction, so only rows that are
    kept pay for it. Numbering writes rows down: with `keys` a level carries
    no more than these, the order and its table's columns.
    """
    rows = first_per_key(df, key, order) if key else df
    rows = shape(rows) if shape else rows
    if keys is not None:
        rows = level_columns(rows, col, [*keys, *order])
    return assign_ids(rows, col, start, order)


def level_columns(rows: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    """The given columns and those of the table which that id numbers, as far as the frame has them."""
    table = next(t for t, c in ID_COLUMNS.items() if c == col)
    wanted = {*keep, *SCHEMAS[table].names}
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c in wanted])


def star_split(
    raw: DataFrame,
    place_key: Sequence[str],
    event_key: Sequence[str] | None,
    order: Sequence[str],
    start: Mapping[str, int],
    place: Callable[[DataFrame], DataFrame] | None = None,
    event: Callable[[DataFrame], DataFrame] | None = None,
    count: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split one wide frame into numbered place, event and count rows.

    Places and events are the first row of their key; without an event key
    every row is its own event and its own count. `start` gives the first id
    of each level. The shape functions must keep the key and order columns;
    a shaped level carries only these and its table's columns.
    """
    keys = [*place_key, *(event_key or ())]
    places = number_rows(raw, place_key, "place_id", start["places"], order, place, keys if place else None)
    events = number_rows(raw, event_key, "event_id", start["events"], order, event, keys if event else None)
    events = lookup(events, places, place_key, ["place_id"])
    if event_key is None:
        # One count per event in the same order: its number follows from the event's.
        numbered = events.withColumn("count_id", F.col("event_id") + (start["counts"] - start["events"]))
        counts = count(numbered) if count else numbered
    else:
        counts = number_rows(raw, None, "count_id", start["counts"], order, count, keys if count else None)
        counts = lookup(counts, events, event_key, ["event_id"])
    return places, events, counts
