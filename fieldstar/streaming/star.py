"""The star of checklists, grown batch by batch.

Every micro-batch is split into places, events and counts as the batch plan
splits a whole input, but for keys that earlier batches brought: their ids are
looked up. Ids go on without gaps. Where they start is part of the commit of
the batch before, so a batch that runs again gets the ids it had.

A batch writes its rows of all tables into folders of its own and then a note
with the ids it used. The note is the commit: readers take the batches that
have one, and a batch that finds its own note does nothing. A batch that died
half way is written over when it is replayed; nobody has read it.

Known keys are read from the tables' own key columns, (lng, lat, id) and (sample,
id): two or three columns of what was written, joined to the distinct keys of
the batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldstar.formats import DATASETS
from fieldstar.operators.joins import lookup
from fieldstar.operators.keys import FILE_ORDER, first_per_key
from fieldstar.operators.reshape import level_columns, number_rows
from fieldstar.plans.checklists import (
    EVENT_KEY,
    PLACE_KEY,
    count_rows,
    event_rows,
    place_rows,
    target_taxa,
    usable_checklists,
)
from fieldstar.plans.common import tagged
from fieldstar.plans.run_all import reject_rows
from fieldstar.schema import ID_COLUMNS, SCHEMAS, SPLIT_TABLES, conform
from fieldstar.session import list_paths, read_note, released_staging, stage, write_note
from fieldstar.sinks.tables import Warehouse
from fieldstar.streaming.ingest import BATCH, skip_if_empty

# Key columns that are no part of a table's contract are kept beside it.
KEYS = {"places": PLACE_KEY, "events": EVENT_KEY}
COMMITS = "_commits"
FIRST = {table: 1 for table in SPLIT_TABLES}


class StreamedStar:
    """Places, events, counts and rejects below a root folder, one folder per batch in each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> list[int]:
        """Batches that ended, in order."""
        names = list_paths(self.spark, f"{self.root}/{COMMITS}")
        return sorted(int(n) for n in names if n.isdigit())

    def next_ids(self, batch_id: int, start: Mapping[str, int]) -> dict[str, int]:
        """First free ids before a batch: those its predecessor left, or the given ones."""
        earlier = [b for b in self.commits() if b < batch_id]
        if not earlier:
            return dict(start)
        return json.loads(read_note(self.spark, f"{self.root}/{COMMITS}/{earlier[-1]}"))

    def _read(self, table: str, schema: T.StructType, before: int | None = None) -> DataFrame:
        done = [b for b in self.commits() if before is None or b < before]
        paths = [f"{self.root}/{table}/{BATCH}={b}" for b in done]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def load(self, table: str) -> DataFrame:
        """The rows of all batches that ended (`rejects`: counts without a readable number)."""
        return self._read(table, SCHEMAS["counts" if table == "rejects" else table])

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.load(t) for t in SPLIT_TABLES}

    def known(self, table: str, before: int) -> DataFrame:
        """(key columns, id) of what earlier batches wrote."""
        kinds = {**{f.name: f.dataType for f in SCHEMAS[table].fields}, **{k: T.StringType() for k in EVENT_KEY}}
        names = [*KEYS[table], ID_COLUMNS[table]]
        return self._read(table, T.StructType([T.StructField(n, kinds[n]) for n in names]), before)

    def add(
        self,
        raw: DataFrame,
        batch_id: int,
        taxa: DataFrame,
        order: Sequence[str],
        start: Mapping[str, int],
        dataset_id: str,
    ) -> None:
        """Split one batch and commit it; a batch that is there already is left alone."""
        if batch_id in self.commits():
            return
        first = self.next_ids(batch_id, start)
        with released_staging(self.spark):
            rows = stage(usable_checklists(raw), "batch")
            places, place_ids = self._level(rows, "places", batch_id, first["places"], order, place_rows)
            events, event_ids = self._level(rows, "events", batch_id, first["events"], order, event_rows, PLACE_KEY)
            counts = number_rows(
                rows, None, "count_id", first["counts"], order, lambda df: count_rows(df, taxa), EVENT_KEY
            )
            used = {"places": places.count(), "events": events.count(), "counts": counts.count()}
            events = lookup(events, place_ids, PLACE_KEY, ["place_id"])
            counts = lookup(counts, event_ids, EVENT_KEY, ["event_id"])
            readable = F.col("count").isNotNull()
            made = {"places": places, "events": events, "counts": counts.filter(readable), "rejects": counts.filter(~readable)}
            for table, df in made.items():
                of = "counts" if table == "rejects" else table
                beside = [k for k in KEYS.get(table, ()) if k not in SCHEMAS[of].names]
                rows = conform(tagged(df, dataset_id), of, beside)
                rows.write.mode("overwrite").parquet(f"{self.root}/{table}/{BATCH}={batch_id}")
        left = {t: first[t] + used[t] for t in SPLIT_TABLES}
        write_note(self.spark, f"{self.root}/{COMMITS}/{batch_id}", json.dumps(left))

    def _level(
        self,
        rows: DataFrame,
        table: str,
        batch_id: int,
        start: int,
        order: Sequence[str],
        shape: Callable[[DataFrame], DataFrame],
        carry: Sequence[str] = (),
    ) -> tuple[DataFrame, DataFrame]:
        """(numbered rows of the batch's new keys, ids of all its keys)."""
        key, id_col = KEYS[table], ID_COLUMNS[table]
        known = self.known(table, batch_id).select(
            *[F.col(k).alias(f"_known_{k}") for k in key], F.col(id_col).alias("_id")
        )
        same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key]
        met = first_per_key(rows, key, order).join(known, same, "left").drop(*[f"_known_{k}" for k in key])
        # Shaped before they are written: only the columns that this level needs are moved and kept.
        met = stage(level_columns(shape(met), id_col, [*key, *carry, *order, "_id"]), f"batch-{table}")
        fresh = number_rows(met.filter("_id is null").drop("_id"), None, id_col, start, order, None, [*key, *carry])
        ids = met.filter("_id is not null").select(*key, F.col("_id").alias(id_col))
        return fresh, ids.unionByName(fresh.select(*key, id_col))

    def publish(self, warehouse: Warehouse, dataset_id: str = "ebird") -> None:
        """Make the streamed rows the dataset's only rows in a warehouse, in one commit."""
        slices = {**self.tables(), "datasets": warehouse.registry_row(DATASETS[dataset_id])}
        lacking = self.load("rejects").withColumn("reason", F.lit("count"))
        warehouse.commit(dataset_id, {**slices, "rejects": reject_rows(lacking, "counts")})


def stream_checklists(
    source: DataFrame,
    root: str,
    checkpoint: str,
    taxa: DataFrame,
    order: Sequence[str] = FILE_ORDER,
    start: Mapping[str, int] | None = None,
    dataset_id: str = "ebird",
) -> StreamingQuery:
    """Grow the star of checklists from a stream of raw observations, until the input is used up.

    The result is that of the batch plan over all rows, ordered by batch first
    and by `order` within one. `start` gives the first id of each table.
    """
    spark = source.sparkSession
    star = StreamedStar(spark, root)
    wanted = target_taxa(taxa)
    first = {**FIRST, **(start or {})}

    def batch(df: DataFrame, batch_id: int) -> None:
        if not skip_if_empty(df):
            star.add(df, batch_id, wanted, order, first, dataset_id)

    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
