"""Arthropod surveys: sites, plants, surveys and records of groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import ARTHROPOD_COUNT_JSON, ARTHROPOD_EVENT_JSON, ARTHROPOD_PLACE_JSON
from fieldstar.functions.jsonblob import json_blob
from fieldstar.functions.numbers import to_int, to_num
from fieldstar.functions.text import prefix
from fieldstar.functions.times import day_of, parse_fixed, year_of
from fieldstar.operators.filters import require
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, assign_ids
from fieldstar.plans.common import Rows, Tables, all_taxa, last_per_key, new_taxa, start_ids, tagged
from fieldstar.schema import conform


def surveyed_plants(surveys: DataFrame, plants: DataFrame, order: Sequence[str]) -> DataFrame:
    """Surveys with their plant; columns both have get _survey and _plant endings."""
    both = (set(surveys.columns) & set(plants.columns)) - set(order)
    left = surveys.withColumnsRenamed({c: f"{c}_survey" for c in both})
    right = plants.drop(*order).withColumnsRenamed({c: f"{c}_plant" for c in both})
    return left.join(right, F.col("PlantFK") == F.col("ID_plant"), "inner")


def arthropods(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "caterpillar",
) -> Rows:
    """Conform the arthropod surveys; raw: sites, plants, surveys, records."""
    start = start_ids(tables)

    groups = raw["records"].select(
        F.col("Group").alias("group"),
        F.col("Group").alias("sci_name"),
        F.lit(None).cast("string").alias("genus"),
        F.lit("").alias("common_name"),
        *order,
    )
    fresh = new_taxa(groups, tables, order, None)
    taxa = all_taxa(tables, fresh).filter(F.col("group").isNotNull())

    sites = assign_ids(raw["sites"], "place_id", start["places"], order)
    places = json_blob(sites, ARTHROPOD_PLACE_JSON.split(), "place_json")
    places = places.withColumns({"lng": to_num(F.col("Longitude")), "lat": to_num(F.col("Latitude"))})

    visits = surveyed_plants(raw["surveys"], raw["plants"], order)
    visits = assign_ids(visits, "event_id", start["events"], order)
    visits = lookup(visits, last_per_key(sites, ["ID"], "place_id"), {"SiteFK": "ID"}, ["place_id"])
    date = parse_fixed(F.col("LocalDate"), "yyyy-MM-dd")
    events = json_blob(visits, ARTHROPOD_EVENT_JSON.split(), "event_json").withColumns(
        {"year": year_of(date), "day": day_of(date), "started": prefix(F.col("LocalTime"), 5)}
    )

    seen = assign_ids(raw["records"], "count_id", start["counts"], order)
    seen = lookup(seen, last_per_key(visits, ["ID_survey"], "event_id"), {"SurveyFK": "ID_survey"}, ["event_id"])
    seen = lookup(seen, last_per_key(taxa, ["sci_name"], "taxon_id"), {"Group": "sci_name"}, ["taxon_id"])
    seen = require(seen.withColumn("count", to_int(F.col("Quantity"))), ["event_id", "taxon_id", "count"])
    counts = json_blob(seen, ARTHROPOD_COUNT_JSON.split(), "count_json")

    return {
        "taxa": fresh,
        "places": conform(tagged(places, dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
