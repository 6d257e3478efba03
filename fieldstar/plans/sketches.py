"""Distinct counts that can be kept and merged: sketches per dataset and year.

An audit's distinct places and events cannot be added up over batches; their
sketches can. A batch leaves one row per dataset and year, however large it is;
merging reads these rows only, and gives for any choice of datasets and years
what a sketch of all their observations would give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 14  # 2^14 registers: a standard error of 0.8 %
SKETCHES = "dataset_id string, year int, places binary, events binary, counts long"


def audit_sketches(audited: DataFrame, targets: DataFrame, dataset_id: Column) -> DataFrame:
    """Sketches of places and events, and the target observations, of each dataset and year.

    `audited` are raw observations that passed the gates, with their `date`.
    Sketches are built in the map tasks: what moves is one per task and year.
    """
    known = targets.select(F.col("sci_name").alias("_name")).distinct().withColumn("_hit", F.lit(1))
    marked = audited.join(known, F.col("SCIENTIFIC_NAME") == F.col("_name"), "left")
    place = F.xxhash64("LONGITUDE", "LATITUDE")
    return marked.groupBy(dataset_id.alias("dataset_id"), F.year("date").alias("year")).agg(
        F.hll_sketch_agg(place, F.lit(LOG_SIZE)).alias("places"),
        F.hll_sketch_agg(F.col("SAMPLING_EVENT_IDENTIFIER").cast("string"), F.lit(LOG_SIZE)).alias("events"),
        F.count("_hit").alias("counts"),
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per dataset and year out of the rows of several batches."""
    return sketches.groupBy("dataset_id", "year").agg(
        F.hll_union_agg("places").alias("places"),
        F.hll_union_agg("events").alias("events"),
        F.sum("counts").cast("long").alias("counts"),
    )


def sketched_totals(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct places and events, and exact counts, of all rows or by dataset or year.

    An observation repeated in two batches is two counts, but one place and event.
    """
    estimate = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).cast("long")
    return sketches.groupBy(*by).agg(
        estimate("places").alias("places"),
        estimate("events").alias("events"),
        F.coalesce(F.sum("counts"), F.lit(0)).cast("long").alias("counts"),
    )
