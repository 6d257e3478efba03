"""The five target tables: columns, types and rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Table names, column names and column order of the star schema.
SCHEMAS: dict[str, T.StructType] = {
    "datasets": _schema(dataset_id="string", title="string", version="string", url="string", extracted="timestamp"),
    "taxa": _schema(
        **{"taxon_id": "long", "sci_name": "string", "group": "string", "class": "string", "order": "string"},
        **{"family": "string", "genus": "string", "common_name": "string", "category": "string"},
        **{"spec": "string", "target": "boolean", "revised_id": "long", "taxon_json": "string"},
    ),
    "places": _schema(
        place_id="long",
        dataset_id="string",
        lng="double",
        lat="double",
        radius="double",
        place_json="string",
        geohash="string",
        geopoint="binary",
    ),
    "events": _schema(
        event_id="long",
        place_id="long",
        dataset_id="string",
        year="int",
        day="int",
        started="string",
        ended="string",
        event_json="string",
    ),
    "counts": _schema(
        count_id="long", event_id="long", dataset_id="string", taxon_id="long", count="int", count_json="string"
    ),
}
TABLES = tuple(SCHEMAS)
SPLIT_TABLES = ("places", "events", "counts")  # each row belongs to one dataset
ID_COLUMNS = {"taxa": "taxon_id", "places": "place_id", "events": "event_id", "counts": "count_id"}


@dataclass(frozen=True)
class Rules:
    """Declared constraints of one table."""

    primary: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign: dict[str, str] = field(default_factory=dict)


RULES: dict[str, Rules] = {
    "datasets": Rules("dataset_id", not_null=("title", "version")),
    "taxa": Rules("taxon_id", unique=("sci_name",), not_null=("sci_name",)),
    "places": Rules("place_id", not_null=("lng", "lat"), foreign={"dataset_id": "datasets"}),
    "events": Rules(
        "event_id", not_null=("year", "day"), foreign={"place_id": "places", "dataset_id": "datasets"}
    ),
    "counts": Rules(
        "count_id",
        not_null=("count",),
        foreign={"event_id": "events", "dataset_id": "datasets", "taxon_id": "taxa"},
    ),
}


def conform(df: DataFrame, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """Project onto a table's column contract, adding typed NULLs for absent columns; `keep` stays beside it."""
    known = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[table].fields
        ],
        *[F.col(f"`{c}`") for c in keep],
    )
