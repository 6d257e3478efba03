"""Lenient numbers and coded measures (Column in, Column out)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number; Java's parser alone would also take "1.0d".
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

COUNT_PRESENT = "X"  # fixed value: "present, not counted"
COUNT_PRESENT_AS = -1  # fixed value
METRES_PER_KM = 1000.0


def to_num(c: Column) -> Column:
    """Text to double; NULL when it is not a number.

    One pass over the text: what does not match is '' and casts to NULL.
    """
    return F.regexp_extract(c.cast("string"), NUMBER, 0).try_cast("double")


def to_real(c: Column) -> Column:
    """SQL-style CAST(... AS REAL); junk becomes NULL instead of 0.0."""
    return to_num(c)


def to_int(c: Column) -> Column:
    """Text such as '3' or '3.0' to int, truncating; NULL when out of range."""
    return to_num(c).try_cast("int")


def total_or_zero(c: Column) -> Column:
    """A total where missing means none: 0; an unreadable one stays NULL."""
    missing = c.isNull() | (F.trim(c.cast("string")) == "")
    return F.when(missing, F.lit(0)).otherwise(to_int(c))


def km_to_m(c: Column) -> Column:
    """Kilometres to metres: missing stays missing, unparsable becomes 0."""
    metres = F.coalesce(to_num(c), F.lit(0.0)) * METRES_PER_KM
    return F.when(c.isNotNull(), metres)


def count_or_x(c: Column) -> Column:
    """Observation count where 'X' (present, not counted) is -1."""
    return F.when(c == COUNT_PRESENT, F.lit(COUNT_PRESENT_AS)).otherwise(to_int(c))


def radius_m(code: Column, table: Mapping[float, Sequence[str]], default: float | None = None) -> Column:
    """Location precision code to a radius in metres, from {radius: codes}."""
    result = F.lit(default).cast("double")
    for metres, codes in table.items():
        result = F.when(code.isin(*codes), F.lit(float(metres))).otherwise(result)
    return result


def fill(c: Column, value) -> Column:
    """Replace NULL by a constant."""
    return F.coalesce(c, F.lit(value))
