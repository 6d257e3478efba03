"""Nest attempts: sampled dates and measures of one nest, one wide row each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import (
    BIRDS,
    NEST_COUNT_JSON,
    NEST_DATES,
    NEST_EVENT_JSON,
    NEST_MEASURES,
    NEST_PLACE_JSON,
    SPECIES_CODE_KEY,
)
from fieldstar.functions.jsonblob import json_blob, json_get
from fieldstar.functions.numbers import to_num
from fieldstar.functions.text import before
from fieldstar.functions.times import NEST_DATE, day_of, fix_century, parse_fixed, year_of
from fieldstar.operators.aggregates import collapse_attempts
from fieldstar.operators.columns import ensure_columns
from fieldstar.operators.filters import require
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, assign_ids
from fieldstar.operators.reshape import melt_counts, melt_events, number_rows
from fieldstar.plans.common import Rows, Tables, last_per_key, start_ids, tagged
from fieldstar.schema import conform
from fieldstar.session import stage


def taxa_by_code(taxa: DataFrame) -> DataFrame:
    """(species_code, taxon_id) from the codes kept in the taxa's blobs."""
    birds = taxa.filter(F.col("class") == BIRDS)
    coded = birds.select(json_get(F.col("taxon_json"), SPECIES_CODE_KEY).alias("species_code"), "taxon_id")
    return last_per_key(coded.dropna(), ["species_code"], "taxon_id")


def usable_attempts(attempts: DataFrame, taxa: DataFrame) -> DataFrame:
    """Attempts with a known taxon, a position and at least one readable date."""
    wanted = [*NEST_DATES, *NEST_MEASURES, *NEST_PLACE_JSON.split(), *NEST_EVENT_JSON.split()[:-2], "SPECIES_CODE"]
    raw = ensure_columns(attempts, wanted)
    raw = lookup(raw, taxa_by_code(taxa), {"SPECIES_CODE": "species_code"}, ["taxon_id"])
    dates = {out: parse_fixed(before(F.col(text), ":"), NEST_DATE) for text, out in NEST_DATES.items()}
    raw = raw.withColumns(
        {
            "lng": to_num(F.col("LONGITUDE")),
            "lat": to_num(F.col("LATITUDE")),
            "LOC_ID": F.coalesce("LOC_ID", F.lit("")),
            "ATTEMPT_ID": F.coalesce("ATTEMPT_ID", F.lit("")),
            **dates,
        }
    )
    return require(raw, ["taxon_id", "lng", "lat"], NEST_DATES.values())


def nest_attempts(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: Tables,
    as_of_year: int,
    order: Sequence[str] = FILE_ORDER,
    dataset_id: str = "nestwatch",
) -> Rows:
    """Conform the nest attempts; raw: attempts. Years after `as_of_year` lose a century."""
    start = start_ids(tables)
    attempts = stage(usable_attempts(raw["attempts"], tables["taxa"]), "attempts")

    sites = number_rows(attempts, ["LOC_ID"], "place_id", start["places"], order)
    places = json_blob(sites, NEST_PLACE_JSON.split(), "place_json")

    located = lookup(attempts, sites, "LOC_ID", ["place_id"])
    texts = [f for f in NEST_EVENT_JSON.split()[:-2] if f != "ATTEMPT_ID"]
    nests = collapse_attempts(
        located,
        "ATTEMPT_ID",
        maxes=NEST_MEASURES,
        firsts=[*texts, "SPECIES_CODE"],
        dates=[*NEST_DATES.values(), "place_id", "taxon_id"],
        order=order,
    )
    nests = stage(nests, "nests")

    dated = melt_events(nests, NEST_DATES)
    dated = assign_ids(dated, "event_id", start["events"], ["event_rank", "ATTEMPT_ID"])
    events = json_blob(dated, NEST_EVENT_JSON.split(), "event_json").withColumns(
        {"year": fix_century(year_of(F.col("date")), as_of_year), "day": day_of(F.col("date"))}
    )

    kept = ["event_id", "ATTEMPT_ID", "SPECIES_CODE", "taxon_id"]
    measured = melt_counts(dated, NEST_MEASURES, kept)
    measured = assign_ids(measured, "count_id", start["counts"], ["count_rank", "ATTEMPT_ID"])
    counts = json_blob(measured, NEST_COUNT_JSON.split(), "count_json")

    return {
        "places": conform(tagged(places.drop("radius"), dataset_id), "places"),
        "events": conform(tagged(events, dataset_id), "events"),
        "counts": conform(tagged(counts, dataset_id), "counts"),
    }
