"""Questions asked of the conformed tables and of the raw observations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstar.formats import CHECKLIST_LAT, CHECKLIST_LNG, MISSING_COLUMNS
from fieldstar.functions.jsonblob import blob_value, json_expand, key_column
from fieldstar.functions.text import tagged_key
from fieldstar.operators.aggregates import counts_by
from fieldstar.operators.columns import prefixed
from fieldstar.operators.filters import bbox, extract_bbox, quality_gate, within
from fieldstar.operators.joins import drop_known
from fieldstar.plans.sketches import audit_sketches, sketched_totals
from fieldstar.schema import SPLIT_TABLES
from fieldstar.sinks.layout import BLOBS, CELL, CELLED, cell_ranges, day_number, in_cells

Tables = Mapping[str, DataFrame]
Range = tuple[float, float]

KEYS = {"place_id", "event_id", "count_id", "taxon_id"}
PREFIXES = {"places": "place_", "events": "event_", "counts": "count_", "taxa": "taxon_"}


def qualified_star(tables: Tables, collide: Iterable[str] = ("dataset_id",)) -> dict[str, DataFrame]:
    """Tables whose shared non-key columns carry the table's prefix, ready to be joined."""
    shared = set(collide)
    return {
        name: prefixed(tables[name], PREFIXES[name], keep=set(tables[name].columns) - shared)
        for name in PREFIXES
        if name in tables
    }


def of_dataset(star: dict[str, DataFrame], dataset_id: str | None) -> dict[str, DataFrame]:
    """The qualified tables cut to one dataset, if one is asked for."""
    if dataset_id is None:
        return star
    cut = {t: star[t].filter(F.col(f"{PREFIXES[t]}dataset_id") == dataset_id) for t in SPLIT_TABLES if t in star}
    return star | cut


def observations(
    tables: Tables,
    places: Column | None = None,
    events: Column | None = None,
    counts: Column | None = None,
    taxa: Column | None = None,
    dataset_id: str | None = None,
    cells: Sequence[Range] | None = None,
) -> DataFrame:
    """places x events x counts x taxa by their ids, each table filtered at its scan.

    A dataset is asked for in all three of its tables: it is their partition,
    so the other datasets' files are not read.

    Everything that can be said about one table is said before the join, so
    the count table, by far the largest, only meets the few events that
    remain; its own scan gets a runtime filter from them. Where only taxa are
    asked for, counts are cut to them by id before they meet the events, so
    that no event is moved with a count that is not wanted. Where the tables'
    layout has them on a curve, `cells` cuts events and counts at their files.
    """
    star = of_dataset(qualified_star(tables), dataset_id)
    for name in CELLED:
        if cells is not None and CELL in star[name].columns:
            star[name] = star[name].filter(in_cells(cells))
    for name, condition in {"places": places, "events": events, "counts": counts, "taxa": taxa}.items():
        if condition is not None:
            star[name] = star[name].filter(condition)
    star = {name: df.drop(CELL) for name, df in star.items()}
    if taxa is not None and places is None and events is None:
        star["counts"] = star["counts"].join(star["taxa"].select("taxon_id"), "taxon_id", "left_semi")
    joined = star["places"].join(star["events"], "place_id").join(star["counts"], "event_id")
    return joined.join(star["taxa"], "taxon_id")


def plain(df: DataFrame) -> DataFrame:
    """The frame without what a layout keeps beside the tables' contracts."""
    marks = tuple(key_column(blob, "") for blob in BLOBS.values())
    return df.drop(*[c for c in df.columns if c.startswith(marks)])


def season_cells(year: int, days: tuple[int, int], lng: Range, lat: Range) -> list[Range]:
    """Ranges of the layout's curve that hold a box and season."""
    return cell_ranges(lng, lat, [day_number(year, d) for d in sorted(days)])


def in_box(lng: Range, lat: Range) -> Column:
    """Places inside a box, edges included."""
    return within(F.col("lng"), lng) & within(F.col("lat"), lat)


def in_season(year: int, days: tuple[int, int]) -> Column:
    """Events of one year between two days of the year."""
    return (F.col("year") == year) & within(F.col("day"), days)


def slice_targets(tables: Tables, year: int, days: tuple[int, int], lng: Range, lat: Range) -> DataFrame:
    """All columns of the target taxa's observations in a box and season."""
    cells = season_cells(year, days, lng, lat)
    return plain(observations(tables, in_box(lng, lat), in_season(year, days), taxa=F.col("target"), cells=cells))


def slice_class(
    tables: Tables, taxon_class: str, year: int, days: tuple[int, int], lng: Range, lat: Range
) -> DataFrame:
    """The same for one class of taxa."""
    wanted = F.col("target") & (F.col("class") == taxon_class)
    cells = season_cells(year, days, lng, lat)
    return plain(observations(tables, in_box(lng, lat), in_season(year, days), taxa=wanted, cells=cells))


def slice_json(
    tables: Tables,
    dataset_id: str | None,
    key: str,
    out: str,
    year: int,
    days: tuple[int, int],
    lng: Range,
    lat: Range,
) -> DataFrame:
    """One dataset's slice with a value out of the event blob, where it has one."""
    found = blob_value(tables["events"], "event_json", key)
    season = in_season(year, days) & found.isNotNull()
    cells = season_cells(year, days, lng, lat)
    rows = observations(tables, in_box(lng, lat), season, taxa=F.col("target"), dataset_id=dataset_id, cells=cells)
    return rows.select("lng", "lat", "year", "day", "count", "sci_name", found.alias(out))


def checklist_count(
    tables: Tables, dataset_id: str | None, key: str, since: int, days: tuple[int, int], lng: Range, lat: Range
) -> DataFrame:
    """Number of events since a year, in a season and box, that carry the key."""
    star = of_dataset(qualified_star(tables), dataset_id)
    places = star["places"].filter(in_box(lng, lat))
    found = blob_value(tables["events"], "event_json", key)
    season = (F.col("year") >= since) & within(F.col("day"), days) & found.isNotNull()
    return places.join(star["events"].filter(season), "place_id").agg(F.count("*").alias("n"))


def slice_top(
    tables: Tables,
    dataset_id: str | None,
    blob: T.StructType | str,
    year: int,
    days: tuple[int, int],
    lng: Range,
    lat: Range,
    order: Sequence[str],
    limit: int = 100,
) -> DataFrame:
    """First rows of a slice, by a total order, with the event blob as columns.

    The blob is parsed after the limit, for the rows that are returned only.
    """
    season = in_season(year, days)
    cells = season_cells(year, days, lng, lat)
    rows = observations(tables, in_box(lng, lat), season, taxa=F.col("target"), dataset_id=dataset_id, cells=cells)
    wanted = ["lng", "lat", "year", "day", "count", "sci_name", "event_json"]
    first = rows.select(*dict.fromkeys([*wanted, *order])).orderBy(*order).limit(limit)
    return json_expand(first, "event_json", blob)


def species_list(tables: Tables, names: Sequence[str]) -> DataFrame:
    """Every observation of the listed species, all columns."""
    return plain(observations(tables, taxa=F.col("sci_name").isin(*names)))


def missing_names(sources: Mapping[str, DataFrame], taxa: DataFrame, order: Mapping[str, Sequence[str]]) -> DataFrame:
    """Names of several sources that the taxonomy lacks, one report for all.

    Each source is a frame with sci_name, common_name and key; a name missing
    from two sources is listed for both.
    """
    columns = MISSING_COLUMNS.split()
    found = [
        drop_known(df, taxa, order[name]).withColumn("dataset", F.lit(name)).select(*columns)
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, found)


def named_source(df: DataFrame, name: Column, common_name: Column, tag: str | None, key: Column | None) -> DataFrame:
    """A species list in the shape `missing_names` wants."""
    label = tagged_key(tag, key) if tag is not None and key is not None else F.lit("")
    return df.withColumns({"sci_name": name, "common_name": common_name, "key": label})


def audited(raw: DataFrame, lng: Range = CHECKLIST_LNG, lat: Range = CHECKLIST_LAT) -> DataFrame:
    """Raw observations an ingest should have kept."""
    return bbox(quality_gate(raw), "LONGITUDE", "LATITUDE", lng, lat)


def audit_species(raw: DataFrame, targets: DataFrame, lng: Range = CHECKLIST_LNG, lat: Range = CHECKLIST_LAT) -> DataFrame:
    """Observations per target species, zeros included, by name."""
    names = targets.select(F.col("sci_name").alias("SCIENTIFIC_NAME"))
    counted = counts_by(audited(raw, lng, lat), "SCIENTIFIC_NAME", names)
    return counted.withColumnRenamed("SCIENTIFIC_NAME", "sci_name").orderBy("sci_name")


def audit_totals(
    raw: DataFrame,
    targets: DataFrame,
    lng: Range = CHECKLIST_LNG,
    lat: Range = CHECKLIST_LAT,
    approximate: bool = False,
) -> DataFrame:
    """Distinct places, distinct events and target observations in one row.

    Reduced to one row per (place, event) before the exact distinct counts.
    `approximate` counts both with sketches, in one pass and without moving
    keys; the observations are exact either way.
    """
    rows = audited(raw, lng, lat)
    if approximate:
        return sketched_totals(audit_sketches(rows, targets, F.lit("")))
    known = targets.select(F.col("sci_name").alias("_name")).distinct().withColumn("_hit", F.lit(1))
    marked = rows.join(known, F.col("SCIENTIFIC_NAME") == F.col("_name"), "left")
    visits = marked.groupBy("LONGITUDE", "LATITUDE", "SAMPLING_EVENT_IDENTIFIER").agg(F.count("_hit").alias("n"))
    return visits.agg(
        F.count_distinct("LONGITUDE", "LATITUDE").alias("places"),
        F.count_distinct("SAMPLING_EVENT_IDENTIFIER").alias("events"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("counts"),
    )


def bbox_extract(raw: DataFrame, lng: Range, lat: Range, **clauses: bool) -> DataFrame:
    """Raw observations inside a box; see `extract_bbox` for the switches."""
    return extract_bbox(raw, lng, lat, **clauses)


def dataset_volumes(tables: Tables) -> DataFrame:
    """Places, events and counts per dataset."""
    sized = [
        tables[t].groupBy("dataset_id").agg(F.count("*").alias(t)) for t in ("places", "events", "counts")
    ]
    return reduce(lambda a, b: a.join(b, "dataset_id", "full"), sized).fillna(0)
