"""Dates, years, days of the year and clock times (Column in, Column out)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldstar.functions.numbers import to_int, to_num

# Declared formats for free-form dates, tried in this order.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
)
ISO_DATE = "yyyy-MM-dd"
NEST_DATE = "ddMMMyyyy"
CLOCK = "HH:mm:ss"


def parse_fixed(c: Column, fmt: str) -> Column:
    """Text in one known format to a timestamp; NULL when it does not match."""
    if fmt == ISO_DATE:  # the cast is several times faster than the formatter
        return F.regexp_extract(c, _shape(fmt), 0).try_cast("date").cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def _shape(fmt: str) -> str:
    """Regular expression for texts a format could match."""
    parts = re.findall(r"'[^']*'|[A-Za-z]+|[^A-Za-z']", fmt)
    shapes = []
    for part in parts:
        if part[0] == "'":
            shapes.append(re.escape(part.strip("'")))
        elif part == "a":
            shapes.append("[AaPp][Mm]")
        elif part.isalpha():
            shapes.append(r"\d{1,2}" if len(part) == 1 else rf"\d{{{len(part)}}}")
        else:
            shapes.append(re.escape(part))
    return f"^{''.join(shapes)}$"


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text in any of the declared formats to a timestamp, else NULL.

    A format is tried only on text of its shape: failed parses are dear.
    """
    if tuple(formats) == (ISO_DATE,):
        return parse_fixed(c, ISO_DATE)
    text = F.trim(c)
    return F.coalesce(*[F.when(text.rlike(_shape(fmt)), parse_fixed(text, fmt)) for fmt in formats])


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from three integers; NULL when there is no such day."""
    zero = F.lit(0)
    return F.try_make_timestamp(
        year.cast("int"), month.cast("int"), day.cast("int"), zero, zero, zero.cast("decimal(16,6)")
    ).cast("date")


def year_of(c: Column) -> Column:
    """Calendar year as int."""
    return F.year(c).cast("int")


def day_of(c: Column) -> Column:
    """Day of the year (1-366) as int."""
    return F.dayofyear(c).cast("int")


def hhmm(c: Column) -> Column:
    """Timestamp to 'HH:MM'."""
    return F.date_format(c, "HH:mm")


def int_hhmm(c: Column) -> Column:
    """Integer hMM to 'HH:MM': missing gives '', an impossible time gives NULL."""
    n = to_int(c)
    hour, minute = F.floor(n / 100), F.pmod(n, F.lit(100))
    clock = F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0"))
    return (
        F.when(to_num(c).isNull(), F.lit(""))
        .when((n >= 0) & (hour < 24) & (minute < 60), clock)
        .otherwise(F.lit(None).cast("string"))
    )


def hhm_to_hhmm(c: Column) -> Column:
    """Three-digit HHm text to 'HH:m0'; missing counts as midnight."""
    text = F.coalesce(c, F.lit("000"))
    padded = F.concat(text, F.lit("00"))
    return F.concat(F.substring(text, 1, 2), F.lit(":"), F.substring(padded, 3, 2))


def end_time(started: Column, minutes: Column) -> Column:
    """Start plus a duration in minutes (may run past midnight); NULL beyond what 18 digits of seconds hold."""
    seconds = (minutes * 60).try_cast("decimal(18,6)")
    zero = F.lit(0)
    return started + F.make_dt_interval(zero, zero, zero, seconds)


def fix_century(year: Column, as_of_year: int) -> Column:
    """Move years that lie in the future back by one century."""
    return F.when(year > as_of_year, year - 100).otherwise(year)
