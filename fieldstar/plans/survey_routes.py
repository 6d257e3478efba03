"""Breeding-survey routes, runs and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import (
    BIRDS,
    ROUTE_COUNT_JSON,
    ROUTE_EVENT_JSON,
    ROUTE_PLACE_JSON,
    ROUTE_RADIUS,
    ROUTE_TAXON_JSON,
)
from fieldstar.functions.jsonblob import json_blob
from fieldstar.functions.numbers import to_int, to_num, total_or_zero
from fieldstar.functions.text import join_name, squeeze_ws, tight_slash
from fieldstar.functions.times import date_from_parts, day_of, int_hhmm
from fieldstar.operators.filters import require
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, assign_ids
from fieldstar.plans.common import (
    Rows,
    Tables,
    all_taxa,
    last_per_key,
    new_taxa,
    start_ids,
    tagged,
    taxon_json_changes,
)
from fieldstar.schema import conform

# The country is part of the keys: state and route numbers repeat across countries.
ROUTE_KEY = ("countrynum", "statenum", "route")
RUN_KEY = (*ROUTE_KEY, "rpid", "year")


def named_species(species: DataFrame) -> DataFrame:
    """Species list with a clean scientific name."""
    name = tight_slash(squeeze_ws(join_name(F.col("genus"), F.col("species"))))
    return species.withColumn("sci_name", name).withColumnsRenamed(
        {"sporder": "order", "english_common_name": "common_name"}
    )


def survey_routes(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "bbs",
) -> Rows:
    """Conform the route survey; raw: species, routes, weather, counts."""
    start = start_ids(tables)

    named = named_species(raw["species"])
    fresh = new_taxa(named, tables, order, BIRDS, ROUTE_TAXON_JSON)
    taxa = all_taxa(tables, fresh)
    by_name = named.select("sci_name", "aou").join(taxa.select("sci_name", "taxon_id"), "sci_name")
    codes = last_per_key(by_name, ["aou"], "taxon_id")

    routes = assign_ids(raw["routes"], "place_id", start["places"], order)
    places = json_blob(routes, ROUTE_PLACE_JSON.split(), "place_json").withColumns(
        {"lng": to_num(F.col("longitude")), "lat": to_num(F.col("latitude")), "radius": F.lit(ROUTE_RADIUS)}
    )

    runs = assign_ids(raw["weather"], "event_id", start["events"], order)
    runs = lookup(runs, last_per_key(routes, ROUTE_KEY, "place_id"), ROUTE_KEY, ["place_id"])
    date = date_from_parts(to_int(F.col("year")), to_int(F.col("month")), to_int(F.col("day")))
    events = json_blob(runs, ROUTE_EVENT_JSON.split(), "event_json").withColumns(
        {
            "year": to_int(F.col("year")),
            "day": day_of(date),
            "started": int_hhmm(F.col("starttime")),
            "ended": int_hhmm(F.col("endtime")),
        }
    )

    seen = assign_ids(raw["counts"], "count_id", start["counts"], order)
    seen = lookup(seen, codes, "aou", ["taxon_id"])
    seen = lookup(seen, last_per_key(runs, RUN_KEY, "event_id"), RUN_KEY, ["event_id"])
    counts = json_blob(require(seen, ["event_id", "taxon_id"]), ROUTE_COUNT_JSON.split(), "count_json")
    counts = counts.withColumn("count", total_or_zero(F.col("speciestotal")))

    return {
        "taxa": fresh,
        "taxon_json": taxon_json_changes(taxa, named, ROUTE_TAXON_JSON, order),
        "places": conform(tagged(places, dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
