"""Butterfly transects: one event and one count per observation row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import BUTTERFLIES, TRANSECT_COUNT_JSON, TRANSECT_EVENT_JSON, TRANSECT_PLACE_JSON
from fieldstar.functions.jsonblob import json_blob
from fieldstar.functions.numbers import to_num, total_or_zero
from fieldstar.functions.text import squeeze_ws
from fieldstar.functions.times import day_of, hhmm, parse_date, year_of
from fieldstar.operators.columns import blanks_to_underscores
from fieldstar.operators.filters import require
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, assign_ids, first_per_key
from fieldstar.plans.common import Rows, Tables, all_taxa, last_per_key, new_taxa, of_class, start_ids, tagged
from fieldstar.schema import conform
from fieldstar.session import stage
from fieldstar.sources.text import normalize_columns_but_order

SITE_KEY = ("Site", "Route")


def usable_observations(observations: DataFrame) -> DataFrame:
    """Observations with a readable start and a species name."""
    obs = normalize_columns_but_order(observations)
    obs = obs.withColumns(
        {"began": parse_date(F.col("Start_time")), "sci_name": squeeze_ws(F.col("Scientific_Name"))}
    )
    return require(obs, ["began", "sci_name"])


def transects(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "pollard",
) -> Rows:
    """Conform the transects; raw: places, observations."""
    start = start_ids(tables)
    obs = stage(usable_observations(raw["observations"]), "transects")

    fresh = new_taxa(obs.withColumn("common_name", F.col("Species")), tables, order, BUTTERFLIES)
    known = of_class(all_taxa(tables, fresh), BUTTERFLIES)

    sites = assign_ids(blanks_to_underscores(raw["places"]), "place_id", start["places"], order)
    extra = [c for c in TRANSECT_PLACE_JSON.split() if c in obs.columns and c not in sites.columns]
    described = lookup(sites, first_per_key(obs.select(*SITE_KEY, *extra, *order), SITE_KEY, order), SITE_KEY, extra)
    places = json_blob(described, TRANSECT_PLACE_JSON.split(), "place_json")
    places = places.withColumns({"lng": to_num(F.col("long")), "lat": to_num(F.col("lat"))})
    places = require(places, ["lng", "lat"])

    # Only places that were kept can be pointed at.
    rows = assign_ids(obs, "event_id", start["events"], order)
    rows = lookup(rows, last_per_key(places, SITE_KEY, "place_id"), SITE_KEY, ["place_id"])
    rows = rows.withColumn("count_id", F.col("event_id") + (start["counts"] - start["events"]))
    rows = require(rows, ["place_id"])

    began, ended = F.col("began"), parse_date(F.col("End_time"))
    events = json_blob(rows, TRANSECT_EVENT_JSON.split(), "event_json").withColumns(
        {"year": year_of(began), "day": day_of(began), "started": hhmm(began), "ended": hhmm(ended)}
    )
    counts = lookup(rows, known, "sci_name", ["taxon_id"], how="inner")
    counts = json_blob(counts, TRANSECT_COUNT_JSON.split(), "count_json")
    counts = counts.withColumn("count", total_or_zero(F.col("Total")))

    return {
        "taxa": fresh,
        "places": conform(tagged(places.drop("radius"), dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
