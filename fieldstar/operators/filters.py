"""Row filters: coordinates, quality gates, codes and required fields."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.functions.numbers import to_num
from fieldstar.functions.times import ISO_DATE, parse_date

WORLD_LNG, WORLD_LAT = (-180.0, 180.0), (-90.0, 90.0)


def within(c: Column, bounds: tuple[float, float]) -> Column:
    """Inclusive range test with the bounds in either order."""
    low, high = sorted(bounds)
    return c.between(low, high)


def bbox(
    df: DataFrame,
    lng: str = "lng",
    lat: str = "lat",
    lng_range: tuple[float, float] = WORLD_LNG,
    lat_range: tuple[float, float] = WORLD_LAT,
) -> DataFrame:
    """Make coordinates numeric and keep rows inside the box, edges included.

    Coordinates that are missing or not numbers become NULL and drop out.
    Numeric columns are compared as they are, so the bounds reach the scan.
    """
    types = dict(df.dtypes)
    text = {c: to_num(F.col(c)) for c in (lng, lat) if types[c] == "string"}
    numeric = df.withColumns(text) if text else df
    return numeric.filter(within(F.col(lng), lng_range) & within(F.col(lat), lat_range))


def quality_gate(
    df: DataFrame, date: str = "OBSERVATION_DATE", out: str = "date", formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Approved and complete observations with a readable date (parsed into `out`).

    The cheap flags go first; only rows that pass them have their date parsed.
    """
    flagged = df.filter((F.col("APPROVED") == "1") & (F.col("ALL_SPECIES_REPORTED") == "1"))
    return flagged.withColumn(out, parse_date(F.col(date), formats)).filter(F.col(out).isNotNull())


def extract_bbox(
    df: DataFrame,
    lng_range: tuple[float, float],
    lat_range: tuple[float, float],
    require_date: bool = True,
    require_approved: bool = True,
    require_complete: bool = True,
    formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """Raw observations inside a box, each quality clause switchable.

    The observation date is parsed whether or not it is required, and rows
    without a unique identifier never pass.
    """
    date = F.col("OBSERVATION_DATE")
    clauses = [F.col("GLOBAL_UNIQUE_IDENTIFIER").isNotNull()]
    if require_approved:
        clauses.append(F.col("APPROVED") == "1")
    if require_complete:
        clauses.append(F.col("ALL_SPECIES_REPORTED") == "1")
    for clause in clauses:
        df = df.filter(clause)
    dated = df.withColumn("OBSERVATION_DATE", parse_date(date, formats))
    if require_date:
        dated = dated.filter(date.isNotNull())
    return bbox(dated, "LONGITUDE", "LATITUDE", lng_range, lat_range)


def not_coded(df: DataFrame, col: str, codes: Iterable[str]) -> DataFrame:
    """Drop rows with one of the codes; rows without a code stay."""
    return df.filter(~F.coalesce(F.col(col).isin(*codes), F.lit(False)))


def require(df: DataFrame, all_of: Iterable[str] = (), any_of: Iterable[str] = ()) -> DataFrame:
    """Keep rows with every `all_of` column and at least one `any_of` column."""
    every, some = list(all_of), list(any_of)
    if every:
        df = df.dropna(how="any", subset=every)
    if some:
        df = df.dropna(how="all", subset=some)
    return df
