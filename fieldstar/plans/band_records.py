"""Band records: bandings, encounters and recaptures, one count per record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import BAND_CODE_COLUMNS, BAND_KINDS, BAND_RADIUS, BAND_RADIUS_DEFAULT, BAND_TOO_COARSE, BIRDS
from fieldstar.functions.jsonblob import json_blob
from fieldstar.functions.numbers import radius_m
from fieldstar.functions.times import day_of, parse_date, year_of
from fieldstar.operators.filters import bbox, not_coded
from fieldstar.operators.joins import code_bridge, lookup
from fieldstar.operators.keys import FILE_ORDER
from fieldstar.operators.reshape import star_split
from fieldstar.plans.common import Rows, Tables, last_per_key, of_class, start_ids, tagged
from fieldstar.schema import conform
from fieldstar.session import stage
from fieldstar.sources.html import CELL, TABLE_ROW, strip_tags
from fieldstar.sources.text import normalize_columns_but_order

PLACE_KEY = ("lng", "lat", "radius")
LIST_PLACE = "_list_place"


def species_codes(pages: DataFrame, html: str = "html", columns: tuple[str, str] = BAND_CODE_COLUMNS) -> DataFrame:
    """(sci_name, species_id, _list_place) from the code list's pages, by the columns that a page's header row names.

    A page without such a header has no codes. Pages are read in the order of
    their hash, the rows of each as they stand.
    """
    cells = F.transform(
        F.regexp_extract_all(F.col(html), F.lit(TABLE_ROW), 1),
        lambda row: F.transform(F.regexp_extract_all(row, F.lit(CELL), 1), strip_tags),
    )
    has = lambda row, name: F.coalesce(F.array_contains(row, name), F.lit(False))
    rows = pages.select(cells.alias("_rows"), F.col(html).alias("_page"))
    header = F.get(F.filter("_rows", lambda row: has(row, columns[0]) & has(row, columns[1])), F.lit(0))
    found = rows.select("_page", header.alias("_header"), F.posexplode("_rows").alias("_line", "_cells"))
    place = lambda name: (F.array_position("_header", name) - 1).cast("int")
    named = found.select(
        F.get("_cells", place(columns[0])).alias("sci_name"),
        F.get("_cells", place(columns[1])).alias("species_id"),
        F.struct(F.xxhash64("_page").alias("page"), F.col("_line").alias("line")).alias(LIST_PLACE),
    )
    return named.filter(F.col("sci_name").isNotNull() & F.col("species_id").rlike("^[0-9]+$"))


def one_kind(records: DataFrame, kind: str, family: int, order: Sequence[str]) -> DataFrame:
    """Records of one kind in the common, narrow shape, blobs packed."""
    names = BAND_KINDS[kind]
    df = normalize_columns_but_order(records).withColumn("TYPE", F.lit(kind))
    df = json_blob(df, names["event_json"].split(), "event_json")
    df = json_blob(df, names["count_json"].split(), "count_json")
    df = json_blob(df, [names["precision"]], "place_json")
    return df.select(
        F.lit(kind).alias("type"),
        F.lit(family).alias("_family"),
        *order,
        F.col(names["lng"]).alias("lng"),
        F.col(names["lat"]).alias("lat"),
        parse_date(F.col(names["date"])).alias("date"),
        F.col(names["species"]).alias("code"),
        F.coalesce(names["precision"], F.lit("")).alias("precision"),
        "place_json",
        "event_json",
        "count_json",
    )


def band_union(raw: Mapping[str, DataFrame], order: Sequence[str]) -> DataFrame:
    """Bandings, encounters and recaptures stacked, in that order."""
    kinds = [one_kind(raw[k], k, i, order) for i, k in enumerate(BAND_KINDS) if k in raw]
    return reduce(DataFrame.unionByName, kinds)


def usable_records(records: DataFrame, codes: DataFrame) -> DataFrame:
    """Records with a date, a known species, and a position that is fine enough."""
    dated = not_coded(records.filter(F.col("date").isNotNull()), "precision", BAND_TOO_COARSE)
    known = lookup(dated, codes, {"code": "species_id"}, ["taxon_id"], how="inner")
    radius = radius_m(F.col("precision"), BAND_RADIUS, BAND_RADIUS_DEFAULT)
    return bbox(known).withColumn("radius", radius)


def band_records(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "bbl",
) -> Rows:
    """Conform the band records; raw: banding, encounter, recapture, and codes or the code_pages they are on.

    A code that the list gives twice means the last of its taxa in list order:
    by the order columns where the list has them, by its place on the pages
    where it is read from these. A list without any order gives the largest id.
    """
    start = start_ids(tables)
    listed = raw["codes"] if "codes" in raw else species_codes(raw["code_pages"])
    listed_order = [c for c in (LIST_PLACE, *order) if c in listed.columns]
    bridge = code_bridge(listed, of_class(tables["taxa"], BIRDS), order=listed_order)
    codes = last_per_key(bridge, ["species_id"], "taxon_id")
    rows = stage(usable_records(band_union(raw, order), codes), "bands")

    places, events, counts = star_split(rows, PLACE_KEY, None, ["_family", *order], start)
    events = events.withColumns({"year": year_of(F.col("date")), "day": day_of(F.col("date"))})
    counts = counts.withColumn("count", F.lit(1))
    return {
        "places": conform(tagged(places, dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
