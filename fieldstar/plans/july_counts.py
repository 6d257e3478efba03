"""Butterfly July counts: one row per site, day and species."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import BUTTERFLIES, JULY_EVENT_JSON, JULY_PLACE_JSON, JULY_TAXON_JSON
from fieldstar.functions.jsonblob import json_blob
from fieldstar.functions.numbers import to_int, to_num, total_or_zero
from fieldstar.functions.text import join_name
from fieldstar.functions.times import date_from_parts, day_of, year_of
from fieldstar.operators.filters import require
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, first_per_key
from fieldstar.operators.reshape import star_split
from fieldstar.plans.common import Rows, Tables, all_taxa, new_taxa, of_class, start_ids, tagged, taxon_json_changes
from fieldstar.schema import conform
from fieldstar.session import stage
from fieldstar.sources.text import normalize_columns_but_order

PLACE_KEY = ("LONGITUDE", "LATITUDE")
DAY = ("iYear", "Month", "Day")


def usable_rows(observations: DataFrame) -> DataFrame:
    """Rows with a position and a whole date; the name is NULL if a part is missing."""
    obs = normalize_columns_but_order(observations)
    numbers = {c: to_num(F.col(c)) for c in PLACE_KEY}
    whole = {c: to_int(F.col(c)) for c in DAY}
    name = join_name(F.col("Gen_Tribe_Fam"), F.col("Species"))
    total = total_or_zero(F.col("SumOfBFLY_COUNT"))
    obs = obs.withColumns({**numbers, **whole, "sci_name": name, "SumOfBFLY_COUNT": total})
    return require(obs, [*PLACE_KEY, *DAY])


def july_counts(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    event_key: Sequence[str] = (*PLACE_KEY, *DAY),
    dataset_id: str = "naba",
) -> Rows:
    """Conform the July counts; raw: observations.

    An event is one place on one day; pass DAY as `event_key` for one event
    per day, shared by all its places.
    """
    start = start_ids(tables)
    obs = stage(usable_rows(raw["observations"]), "july")

    named = require(obs, ["SPECIES_CODE", "sci_name"]).withColumn("common_name", F.lit(""))
    fresh = new_taxa(named, tables, order, BUTTERFLIES, JULY_TAXON_JSON)
    taxa = all_taxa(tables, fresh)

    places, events, counts = star_split(obs, PLACE_KEY, event_key, order, start)
    places = json_blob(places, JULY_PLACE_JSON.split(), "place_json").withColumns(
        {"lng": F.col("LONGITUDE"), "lat": F.col("LATITUDE")}
    )
    date = date_from_parts(*[F.col(c) for c in DAY])
    events = json_blob(events, JULY_EVENT_JSON.split(), "event_json")
    events = events.withColumns({"year": year_of(date), "day": day_of(date)})
    counts = lookup(counts, of_class(taxa, BUTTERFLIES), "sci_name", ["taxon_id"])
    counts = require(counts, ["event_id", "taxon_id"]).withColumns(
        {"count": F.col("SumOfBFLY_COUNT"), "count_json": F.lit("{}")}
    )

    firsts = first_per_key(named, ["sci_name"], order)
    return {
        "taxa": fresh,
        "taxon_json": taxon_json_changes(taxa, firsts, JULY_TAXON_JSON, order),
        "places": conform(tagged(places.drop("radius"), dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
