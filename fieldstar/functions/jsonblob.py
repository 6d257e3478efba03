"""Per-row JSON blobs holding a source's leftover fields."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _usable(df: DataFrame, name: str) -> Column:
    """The column with '' read as missing (missing keys are left out of blobs)."""
    c = F.col(f"`{name}`")
    return F.nullif(c, F.lit("")) if isinstance(df.schema[name].dataType, T.StringType) else c


def _present_fields(df: DataFrame, fields: Iterable[str]) -> list[str]:
    """Wanted fields the frame has, each once, in the wanted order."""
    known = {c.lower(): c for c in df.columns}
    return [f for f in dict.fromkeys(fields) if f.lower() in known]


def json_blob(df: DataFrame, fields: Iterable[str], out: str) -> DataFrame:
    """Pack fields into one JSON object column, leaving out NULL and ''."""
    names = _present_fields(df, fields)
    if not names:
        return df.withColumn(out, F.lit("{}"))
    known = {c.lower(): c for c in df.columns}
    packed = F.struct(*[_usable(df, known[n.lower()]).alias(n) for n in names])
    return df.withColumn(out, F.to_json(packed))


def json_merge(df: DataFrame, blob: str, fields: Iterable[str] | Mapping[str, str], out: str | None = None) -> DataFrame:
    """Merge present fields into an existing blob column.

    Keys already in the blob keep their place and their JSON type; a merged
    field replaces the old value only where it is neither NULL nor ''. A blob
    that is not a JSON object is left as it is.
    `fields` may map the JSON key to the column that feeds it.
    """
    pairs = fields if isinstance(fields, Mapping) else {f: f for f in fields}
    entries = [x for key, col in pairs.items() for x in (F.lit(key), _usable(df, col).cast("variant"))]
    new = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
    old = F.from_json(F.coalesce(F.col(blob), F.lit("{}")), "map<string,variant>")
    kept = F.transform_values(old, lambda k, v: F.coalesce(F.element_at(new, k), v))
    added = F.map_filter(new, lambda k, _: ~F.map_contains_key(old, k))
    merged = F.to_json(F.map_concat(kept, added))
    return df.withColumn(out or blob, F.coalesce(merged, F.col(blob)))


def json_get(c: Column, key: str) -> Column:
    """Value of a top-level key as text; NULL when the key is missing."""
    return F.get_json_object(c, f"$['{key}']")


def key_column(blob: str, key: str) -> str:
    """Name of the column that holds a declared key of a blob beside it."""
    return f"{blob}__{key}"


def with_keys(df: DataFrame, blob: str, keys: Iterable[str]) -> DataFrame:
    """Add the values of declared keys as columns, so that later readers need not parse the blob."""
    return df.withColumns({key_column(blob, k): json_get(F.col(blob), k) for k in keys})


def blob_value(df: DataFrame, blob: str, key: str) -> Column:
    """Value of a blob's key: its column where the frame has one, else parsed out of the blob."""
    beside = key_column(blob, key)
    return F.col(f"`{beside}`") if beside in df.columns else json_get(F.col(blob), key)


def json_has(c: Column, key: str) -> Column:
    """Whether the blob has a (non-null) top-level key."""
    return json_get(c, key).isNotNull()


def json_expand(df: DataFrame, blob: str, schema: str | T.StructType, prefix: str = "") -> DataFrame:
    """Turn a blob into typed columns, parsing it once for all of them."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = df.withColumn("_blob", F.from_json(F.col(blob), struct))
    fields = {f"{prefix}{f.name}": F.col("_blob")[f.name] for f in struct.fields}
    return parsed.withColumns(fields).drop("_blob")
