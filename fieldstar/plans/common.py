"""Steps the dataset plans share.

A plan takes the raw frames of one source and the current tables, and returns
the rows to append, keyed by target table. Besides table names the result may
hold `taxon_json` / `taxon_spec` (changes to known taxa) and `rejects`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.formats import DATASETS
from fieldstar.functions.jsonblob import json_blob, json_merge
from fieldstar.functions.text import genus_of
from fieldstar.operators.columns import ensure_columns
from fieldstar.operators.joins import drop_known
from fieldstar.operators.keys import assign_ids, first_per_key, next_id
from fieldstar.schema import ID_COLUMNS, conform

Tables = Mapping[str, DataFrame]
Rows = dict[str, DataFrame]


def start_ids(tables: Tables) -> dict[str, int]:
    """First free id of every numbered table."""
    return {t: next_id(tables[t], c) for t, c in ID_COLUMNS.items()}


def new_taxa(named: DataFrame, tables: Tables, order: Sequence[str], taxon_class: str | None, fields: str = "") -> DataFrame:
    """Numbered taxa rows for the names the taxonomy lacks."""
    fresh = drop_known(named.dropna(subset=["sci_name"]), tables["taxa"], order)
    shaped = fresh.withColumn("class", F.lit(taxon_class).cast("string"))
    if "genus" not in fresh.columns:
        shaped = shaped.withColumn("genus", genus_of(F.col("sci_name")))
    packed = json_blob(shaped, fields.split(), "taxon_json")
    return conform(assign_ids(packed, "taxon_id", next_id(tables["taxa"], "taxon_id"), order), "taxa")


def all_taxa(tables: Tables, fresh: DataFrame) -> DataFrame:
    """Known and new taxa together."""
    return conform(tables["taxa"], "taxa").unionByName(fresh)


def taxon_json_changes(taxa: DataFrame, named: DataFrame, fields: str, order: Sequence[str]) -> DataFrame:
    """(taxon_id, taxon_json) with a source's fields merged in; its last row per taxon wins."""
    names = fields.split()
    own = ensure_columns(named, names).select(*dict.fromkeys(["sci_name", *names, *order]))
    matched = taxa.select("sci_name", "taxon_id", "taxon_json").join(own, "sci_name")
    latest = first_per_key(matched, ["taxon_id"], order, last=True)
    return json_merge(latest, "taxon_json", names).select("taxon_id", "taxon_json")


def of_class(taxa: DataFrame, taxon_class: str) -> DataFrame:
    """(sci_name, taxon_id) of one class of taxa."""
    return taxa.filter(F.col("class") == taxon_class).select("sci_name", "taxon_id")


def last_per_key(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Key-unique (keys, id) table for lookups; the largest id of a key wins."""
    return df.groupBy(*keys).agg(F.max(col).alias(col))


def tagged(df: DataFrame, dataset_id: str) -> DataFrame:
    """Mark rows with their dataset."""
    return df.withColumn("dataset_id", F.lit(dataset_id))


def dataset(name: str) -> dict[str, str]:
    """Registry row of a dataset."""
    return dict(DATASETS[name])
