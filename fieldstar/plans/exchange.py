"""Export, import and geographic enrichment of the conformed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.functions.geo import geohash, wkb_point
from fieldstar.sinks.files import export_csv, import_tables


def geo_enrich(places: DataFrame, length: int = 7) -> DataFrame:
    """Add the geohash and the WKB point of every place."""
    lng, lat = F.col("lng"), F.col("lat")
    return places.withColumns({"geohash": geohash(lng, lat, length), "geopoint": wkb_point(lng, lat)})


def export_all(tables: Mapping[str, DataFrame], path: str, items: Iterable[str] | None = None) -> list[str]:
    """Export the given tables or datasets; by default every whole table."""
    return [folder for item in (items or tables) for folder in export_csv(tables, item, path)]


def export_import(spark: SparkSession, tables: Mapping[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Round trip through CSV, with places enriched on the way in."""
    export_all(tables, path)
    imported = import_tables(spark, path, {t: [f"{t}.csv"] for t in tables})
    if "places" in imported:
        imported["places"] = geo_enrich(imported["places"])
    return imported
