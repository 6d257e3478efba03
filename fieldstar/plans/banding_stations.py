"""Banding stations: station list, effort, breeding status and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import (
    BIRDS,
    STATION_COUNT_JSON,
    STATION_EVENT_JSON,
    STATION_PLACE_JSON,
    STATION_RADIUS,
)
from fieldstar.functions.jsonblob import json_blob
from fieldstar.functions.numbers import fill, radius_m, to_num
from fieldstar.functions.text import genus_of, prefix, squeeze_ws
from fieldstar.functions.times import day_of, parse_date, year_of
from fieldstar.operators.aggregates import effort_events
from fieldstar.operators.filters import bbox
from fieldstar.operators.joins import backfill_scalar, lookup, missing_codes
from fieldstar.operators.keys import FILE_ORDER, assign_ids, first_per_key
from fieldstar.plans.common import Rows, Tables, all_taxa, last_per_key, new_taxa, start_ids, tagged
from fieldstar.schema import conform
from fieldstar.session import stage

EVENT_KEY = ("STA", "NET", "DATE")


def station_places(stations: DataFrame) -> DataFrame:
    """Places of the numbered stations that have a usable code and position."""
    coded = stations.filter(F.length("STA") > 3)
    located = bbox(coded.withColumns({"lng": to_num(F.col("DECLNG")), "lat": to_num(F.col("DECLAT"))}))
    radius = radius_m(F.col("PRECISION"), STATION_RADIUS)
    return json_blob(located.withColumn("radius", radius), STATION_PLACE_JSON.split(), "place_json")


def banding_stations(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "maps",
) -> Rows:
    """Conform the banding stations; raw: species, stations, effort, status, bands.

    A code the taxonomy lacks is given to the known taxon of that name, or to
    a new taxon when the name is unknown too.
    """
    start = start_ids(tables)
    net = fill(F.col("NET"), "?")

    listed = raw["species"].withColumn("sci_name", squeeze_ws(F.col("SCINAME")))
    listed = listed.withColumns({"genus": genus_of(F.col("sci_name")), "common_name": F.col("COMMONNAME")})
    uncoded = missing_codes(listed, tables["taxa"], "spec")
    fresh = new_taxa(uncoded, tables, order, BIRDS)
    known = lookup(uncoded, tables["taxa"].select("sci_name", "taxon_id"), "sci_name", ["taxon_id"], how="inner")
    coded = first_per_key(known, ["taxon_id"], order).select("taxon_id", "spec")
    taxa = all_taxa(tables, fresh)
    codes = taxa.filter(F.col("spec").isNotNull()).select("spec", "taxon_id")
    codes = last_per_key(codes.unionByName(coded.select("spec", "taxon_id")), ["spec"], "taxon_id")

    stations = assign_ids(raw["stations"], "place_id", start["places"], order)
    places = station_places(stations)

    bands = raw["bands"].withColumns({"NET": net, "year": prefix(F.col("DATE"), 4)})
    bands = assign_ids(bands, "count_id", start["counts"], order)

    effort = raw["effort"].withColumn("NET", net)
    visits = assign_ids(effort_events(bands, effort, stations, places), "event_id", start["events"], EVENT_KEY)
    date = parse_date(F.col("DATE"))
    events = json_blob(visits, STATION_EVENT_JSON.split(), "event_json")
    events = events.withColumns({"year": year_of(date), "day": day_of(date)})

    counts = lookup(bands, visits, EVENT_KEY, ["event_id"], how="inner")
    counts = lookup(counts, codes, {"SPEC": "spec"}, ["taxon_id"], how="inner").withColumn("count", F.lit(1))
    status_key = {"year": "YR", "STA": "STA", "SPEC": "SPEC"}
    counts = backfill_scalar(counts, raw["status"], status_key, {"YS": "YS"}, order)
    counts = json_blob(counts, STATION_COUNT_JSON.split(), "count_json")

    return {
        "taxa": fresh,
        "taxon_spec": stage(coded, "spec"),
        "places": conform(tagged(places, dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
