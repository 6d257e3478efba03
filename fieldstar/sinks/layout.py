"""What a warehouse keeps beside its tables' contracts, so that slices read less.

Declared keys of a blob are written as columns: a query that asks for one reads
a column instead of parsing every blob. Cells place events and counts on a
space-filling curve over longitude, latitude and time: files are cut along it,
and a slice turns its box and season into a few ranges of the curve, which the
statistics of files and row groups are compared with. Counts carry the cell of
their event, so a slice of the largest table reads its own part only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.functions.jsonblob import key_column, with_keys
from fieldstar.operators.joins import lookup

CELL = "cell"
CELLED = ("events", "counts")
BLOBS = {"taxa": "taxon_json", "places": "place_json", "events": "event_json", "counts": "count_json"}

BITS = 11  # per axis
SIDE = 1 << BITS
LNG, LAT = (-180.0, 360.0), (-90.0, 180.0)  # start and span
YEAR_DAYS, FIRST_YEAR, STEP_DAYS = 366, 1900, 36  # 2048 steps of 36 days reach two centuries

# Masks that leave two zero bits between the bits of a number.
SPREAD = (
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
)


def _step(value: Column, first: float, width: float) -> Column:
    """Whole step a value falls in, the outer steps taking what lies beyond."""
    return F.least(F.greatest(F.floor((value - first) / width), F.lit(0)), F.lit(SIDE - 1)).cast("long")


def _spread(axis: Column) -> Column:
    return reduce(lambda x, s: x.bitwiseOR(F.shiftleft(x, s[0])).bitwiseAND(F.lit(s[1])), SPREAD, axis)


def day_number(year: Column | int, day: Column | int) -> Column | int:
    return (year - FIRST_YEAR) * YEAR_DAYS + day


def cell(lng: Column, lat: Column, year: Column, day: Column) -> Column:
    """Place on the curve; NULL where any part is missing."""
    axes = (
        _step(lng, LNG[0], LNG[1] / SIDE),
        _step(lat, LAT[0], LAT[1] / SIDE),
        _step(day_number(year, day), 0, STEP_DAYS),
    )
    known = reduce(Column.__and__, [c.isNotNull() for c in (lng, lat, year, day)])
    x, y, t = (_spread(a) for a in axes)
    return F.when(known, x.bitwiseOR(F.shiftleft(y, 1)).bitwiseOR(F.shiftleft(t, 2)))


def _clamped(value: float, first: float, width: float) -> int:
    return int(min(max((value - first) // width, 0), SIDE - 1))


def cell_ranges(lng: Sequence[float], lat: Sequence[float], days: Sequence[int], most: int = 32) -> list[tuple[int, int]]:
    """Inclusive ranges of the curve that cover a box (`days`: first and last day number).

    Cubes that the box cuts are split until `most` would be passed.
    """
    box = [
        tuple(_clamped(v, first, width) for v in sorted(bounds))
        for bounds, first, width in (
            (lng, LNG[0], LNG[1] / SIDE),
            (lat, LAT[0], LAT[1] / SIDE),
            (days, 0, STEP_DAYS),
        )
    ]

    def overlap(corner: tuple, size: int) -> bool:
        return all(c <= high and c + size - 1 >= low for c, (low, high) in zip(corner, box, strict=True))

    def inside(corner: tuple, size: int) -> bool:
        return all(low <= c and c + size - 1 <= high for c, (low, high) in zip(corner, box, strict=True))

    whole, cut, size = [], [(0, (0, 0, 0))], SIDE
    while size > 1:
        half = size // 2
        parts = [
            (first + place * half**3, tuple(c + half * (place >> axis & 1) for axis, c in enumerate(corner)))
            for first, corner in cut
            for place in range(8)
        ]
        parts = [p for p in parts if overlap(p[1], half)]
        done = [(first, first + half**3 - 1) for first, corner in parts if inside(corner, half)]
        rest = [p for p in parts if not inside(p[1], half)]
        if len(whole) + len(done) + len(rest) > most:
            break
        whole, cut, size = whole + done, rest, half
    merged: list[tuple[int, int]] = []
    for low, high in sorted(whole + [(first, first + size**3 - 1) for first, _ in cut]):
        if merged and merged[-1][1] + 1 == low:
            merged[-1] = (merged[-1][0], high)
        else:
            merged.append((low, high))
    return merged


def in_cells(ranges: Sequence[tuple[int, int]]) -> Column:
    """Rows whose cell lies in one of the ranges, or that have none."""
    return reduce(Column.__or__, [F.col(CELL).between(*r) for r in ranges], F.col(CELL).isNull())


@dataclass(frozen=True)
class Layout:
    """Keys of blobs kept as columns, by table, and whether events and counts lie along the curve."""

    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    cells: bool = False

    def to_text(self) -> str:
        return json.dumps({"keys": {t: list(k) for t, k in self.keys.items()}, "cells": self.cells}, sort_keys=True)

    @staticmethod
    def from_text(text: str) -> Layout:
        return Layout(**json.loads(text))

    def beside(self, table: str) -> dict[str, str]:
        """Columns that a table's files have beside its contract, with their types."""
        found = {key_column(BLOBS[table], k): "string" for k in self.keys.get(table, ())}
        return found | ({CELL: "long"} if self.cells and table in CELLED else {})

    def applied(self, df: DataFrame, table: str, places: DataFrame, events: DataFrame) -> DataFrame:
        """The rows with these columns; `events` have a cell where `df` are counts."""
        if self.keys.get(table):
            df = with_keys(df, BLOBS[table], self.keys[table])
        if not self.cells or table not in CELLED:
            return df
        if table == "counts":
            return lookup(df, events, "event_id", [CELL])
        placed = lookup(df, places, "place_id", {"lng": "_lng", "lat": "_lat"})
        here = cell(F.col("_lng"), F.col("_lat"), F.col("year"), F.col("day"))
        return placed.withColumn(CELL, here).drop("_lng", "_lat")

    def cut(self, df: DataFrame, table: str, partition: str, then: Sequence[str]) -> DataFrame:
        """Rows dealt and sorted the way the table's files are to be cut."""
        if not self.cells:
            return df.sortWithinPartitions(partition, *then)
        if table == "places":
            along = cell(F.col("lng"), F.col("lat"), F.lit(FIRST_YEAR), F.lit(0))
            return df.repartitionByRange(partition, along).sortWithinPartitions(partition, along)
        return df.repartitionByRange(partition, CELL).sortWithinPartitions(partition, CELL, *then)
