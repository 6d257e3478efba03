"""Base taxonomy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import BIRDS, TAXONOMY_JSON, TAXONOMY_RENAMES
from fieldstar.functions.text import squeeze_ws
from fieldstar.operators.columns import blanks_to_underscores, rename
from fieldstar.operators.joins import flag_members
from fieldstar.operators.keys import FILE_ORDER
from fieldstar.plans.common import Rows, Tables, new_taxa


def base_taxonomy(
    spark: SparkSession, raw: Mapping[str, DataFrame], tables: Tables, order: Sequence[str] = FILE_ORDER
) -> Rows:
    """Taxa of the checklist taxonomy; raw: taxonomy, targets."""
    named = blanks_to_underscores(rename(raw["taxonomy"], TAXONOMY_RENAMES))
    named = named.withColumn("sci_name", squeeze_ws(F.col("sci_name")))
    flagged = flag_members(named, raw["targets"], "sci_name", "target")
    flagged = flagged.withColumn("target", F.when(F.col("target"), F.lit(True)))
    return {"taxa": new_taxa(flagged, tables, order, BIRDS, TAXONOMY_JSON)}
