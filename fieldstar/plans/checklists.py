"""Checklist observations, the largest source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import (
    BIRDS,
    CHECKLIST_COUNT_JSON,
    CHECKLIST_EVENT_JSON,
    CHECKLIST_LAT,
    CHECKLIST_LNG,
    CHECKLIST_PLACE_JSON,
    CHECKLIST_RENAMES,
    MISSED_SPECIES,
)
from fieldstar.functions.jsonblob import blob_value, json_blob
from fieldstar.functions.numbers import count_or_x, km_to_m, to_num
from fieldstar.functions.times import CLOCK, day_of, end_time, hhmm, parse_fixed, year_of
from fieldstar.operators.columns import rename
from fieldstar.operators.filters import bbox, quality_gate
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, assign_ids
from fieldstar.operators.reshape import star_split
from fieldstar.plans.common import Rows, Tables, last_per_key, start_ids, tagged
from fieldstar.schema import conform
from fieldstar.session import stage
from fieldstar.sources.text import normalize_columns_but_order

PLACE_KEY = ("lng", "lat")
EVENT_KEY = ("SAMPLING_EVENT_IDENTIFIER",)


def usable_checklists(raw: DataFrame) -> DataFrame:
    """Approved, complete, dated observations inside the study box."""
    named = rename(normalize_columns_but_order(raw), CHECKLIST_RENAMES)
    return bbox(quality_gate(named), "lng", "lat", CHECKLIST_LNG, CHECKLIST_LAT)


def place_rows(rows: DataFrame) -> DataFrame:
    """Places: radius in metres and the location fields."""
    sized = rows.withColumn("radius", km_to_m(F.col("radius")))
    return json_blob(sized, CHECKLIST_PLACE_JSON.split(), "place_json")


def event_rows(rows: DataFrame) -> DataFrame:
    """Events: year, day, start and end of the checklist."""
    begun = parse_fixed(F.col("started"), CLOCK)
    ended = end_time(begun, to_num(F.col("DURATION_MINUTES")))
    packed = json_blob(rows, CHECKLIST_EVENT_JSON.split(), "event_json")
    return packed.withColumns(
        {
            "year": year_of(F.col("date")),
            "day": day_of(F.col("date")),
            "started": hhmm(begun),
            "ended": hhmm(ended),
        }
    )


def count_rows(rows: DataFrame, taxa: DataFrame) -> DataFrame:
    """Counts of the wanted taxa; an unreadable number of birds is NULL."""
    known = lookup(rows, taxa, {"SCIENTIFIC_NAME": "sci_name"}, ["taxon_id"], how="inner")
    counted = known.withColumn("count", count_or_x(F.col("count")))
    return json_blob(counted, CHECKLIST_COUNT_JSON.split(), "count_json")


def target_taxa(taxa: DataFrame) -> DataFrame:
    """(sci_name, taxon_id) of the target birds."""
    return taxa.filter(F.col("target") & (F.col("class") == BIRDS)).select("sci_name", "taxon_id")


def split_checklists(
    rows: DataFrame, taxa: DataFrame, order: Sequence[str], start: Mapping[str, int]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbered places, events and counts of usable checklists."""
    return star_split(
        rows, PLACE_KEY, EVENT_KEY, order, start, place_rows, event_rows, lambda df: count_rows(df, taxa)
    )


def checklists(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "ebird",
) -> Rows:
    """Conform the checklists; raw: checklists.

    Places and events are kept for checklists without any target species too:
    they are the effort behind a zero. Counts that are not numbers are rejects.
    """
    rows = stage(usable_checklists(raw["checklists"]), "checklists")
    places, events, counts = split_checklists(rows, target_taxa(tables["taxa"]), order, start_ids(tables))
    counts = tagged(counts, dataset_id)
    return {
        "places": conform(tagged(places, dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(counts.filter(F.col("count").isNotNull()), "counts"),
        "rejects": conform(counts.filter(F.col("count").isNull()), "counts"),
    }


def event_keys(events: DataFrame) -> DataFrame:
    """(sample_id, event_id): the checklist identifier of each event, out of its blob if no column beside it has it."""
    sample = blob_value(events, "event_json", EVENT_KEY[0])
    return last_per_key(events.select(sample.alias("sample_id"), "event_id"), ["sample_id"], "event_id")


def backfill_rows(raw: DataFrame, known: DataFrame, taxa: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts of the named species on checklists that are already events (`known`: their `event_keys`)."""
    rows = normalize_columns_but_order(raw).filter(F.col("SCIENTIFIC_NAME").isin(*names))
    rows = rename(rows, {"OBSERVATION_COUNT": "count"})
    wanted = taxa.filter(F.col("sci_name").isin(*names)).select("sci_name", "taxon_id")
    located = lookup(rows, known, {EVENT_KEY[0]: "sample_id"}, ["event_id"], how="inner")
    return count_rows(located, wanted)


def backfill_species(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    names: Sequence[str] = MISSED_SPECIES,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "ebird",
) -> Rows:
    """Add counts of species that were missed before; raw: checklists."""
    events = tables["events"].filter(F.col("dataset_id") == dataset_id)
    missed = backfill_rows(raw["checklists"], event_keys(events), tables["taxa"], names)
    counts = tagged(assign_ids(missed, "count_id", start_ids(tables)["counts"], order), dataset_id)
    return {
        "counts": conform(counts.filter(F.col("count").isNotNull()), "counts"),
        "rejects": conform(counts.filter(F.col("count").isNull()), "counts"),
    }
