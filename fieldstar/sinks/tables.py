"""The star schema as Parquet tables below one root folder."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstar.operators.joins import lookup
from fieldstar.schema import SCHEMAS, TABLES, conform
from fieldstar.session import delete_path, list_paths, move_path, path_exists, read_note, write_note
from fieldstar.sinks.layout import CELL, Layout

PARTITIONED = ("datasets", "places", "events", "counts")
PARTITION = "dataset_id"
REJECTS = "dataset_id string, `table` string, reason string, row string"
RUNS = "dataset_id string, fingerprint string, finished timestamp"
SIDE_TABLES = ("rejects", "runs")  # by dataset too, but no part of the star
BESIDE, READY, LAYOUT = "_beside", "_ready", "_layout"
KINDS = {"string": T.StringType(), "long": T.LongType()}

# What slices are cut by: rows are written in this order within each file, so
# the row groups' statistics skip the seasons and latitudes not asked for.
CLUSTERED = {"places": ("lat", "lng"), "events": ("year", "day"), "counts": ("event_id",)}


class Warehouse:
    """Load, append, replace, drop and register over the five tables.

    Tables with a dataset id are partitioned by it, so a dataset's slice is
    read, replaced or exported without touching the others.
    """

    def __init__(self, spark: SparkSession, root: str, layout: Layout | None = None):
        """Open a warehouse; a new one may be given a layout, which is noted and holds for all its files."""
        self.spark, self.root = spark, root.rstrip("/")
        noted = read_note(spark, f"{self.root}/{LAYOUT}")
        self.layout = Layout.from_text(noted) if noted else Layout()
        if layout is not None and layout.to_text() != self.layout.to_text():
            if noted or any(self.exists(t) for t in TABLES):
                raise ValueError(f"{self.root} has another layout; copy its tables into a new warehouse")
            write_note(spark, f"{self.root}/{LAYOUT}", layout.to_text())
            self.layout = layout

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        """Whether the table has been written."""
        return path_exists(self.spark, self.path(table))

    def load(self, table: str, beside: bool = False) -> DataFrame:
        """The table as a frame with its declared schema; empty if not there yet.

        With `beside`, what the layout keeps beside the contract comes along.
        """
        extra = self.layout.beside(table)
        schema = T.StructType([*SCHEMAS[table].fields, *[T.StructField(n, KINDS[k]) for n, k in extra.items()]])
        if not self.exists(table):
            df = self.spark.createDataFrame([], schema)
        else:
            df = self.spark.read.schema(schema).parquet(self.path(table))
        return conform(df, table, list(extra) if beside else ())

    def tables(self, beside: bool = False) -> dict[str, DataFrame]:
        """All tables; with `beside`, reports use what the layout keeps."""
        return {t: self.load(t, beside) for t in TABLES}

    def _shaped(self, df: DataFrame, table: str, slices: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """The rows as they are written: the contract, and what the layout keeps beside it.

        Places and events that are written together (`slices`) are looked up
        there, others in the warehouse.
        """
        extra = self.layout.beside(table)
        if not extra:
            return conform(df, table)
        stored = {t: self.load(t, beside=True) for t in ("places", "events")} | dict(slices or {})
        events = stored["events"]
        if table == "counts" and CELL in extra and CELL not in events.columns:
            events = self.layout.applied(events, "events", stored["places"], events)
        return conform(self.layout.applied(conform(df, table), table, stored["places"], events), table, list(extra))

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows; columns are brought to the table's contract."""
        self._writer(self._shaped(df, table), table).mode("append").parquet(self.path(table))

    def replace_dataset(self, df: DataFrame, table: str, dataset_id: str) -> None:
        """Make `df` the table's only rows of that dataset.

        The partition is swapped when the write commits. A write of no rows
        swaps nothing, so then the old partition is removed; the row count
        comes from the write itself.
        """
        rows = Observation()
        slice_ = self._shaped(df, table).withColumn(PARTITION, F.lit(dataset_id))
        writer = self._writer(slice_.observe(rows, F.count(F.lit(1)).alias("n")), table)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(table))
        if not rows.get["n"]:
            delete_path(self.spark, f"{self.path(table)}/{PARTITION}={dataset_id}")

    def delete_dataset(self, dataset_id: str) -> None:
        """Remove a dataset's rows everywhere but in the shared taxonomy."""
        for table in PARTITIONED:
            delete_path(self.spark, f"{self.path(table)}/{PARTITION}={dataset_id}")

    def commit(
        self, dataset_id: str, slices: Mapping[str, DataFrame], whole: Mapping[str, DataFrame] | None = None
    ) -> None:
        """Replace a dataset's rows in every table that has any, and whole tables with them, in one step.

        All frames are written beside the tables first; nothing of the old rows
        is touched before the last write is done. Then a note lists what was
        written, and folders are renamed into place. A session that dies among
        the writes leaves the old rows; one that dies among the renames leaves
        the note, and `recover` ends its work. A table without a slice loses
        the dataset's rows; the taxonomy is shared and only replaced as a whole.
        """
        self.recover()
        beside = self._beside(dataset_id)
        delete_path(self.spark, beside)
        for table, df in slices.items():
            shaped = self._shaped(df, table, slices) if table in SCHEMAS else df
            slice_ = shaped.withColumn(PARTITION, F.lit(dataset_id))
            self._writer(slice_, table).parquet(f"{beside}/{table}")
        for table, df in (whole or {}).items():
            self._shaped(df, table).write.parquet(f"{beside}/{table}")
        note = {"dataset": dataset_id, "slices": list(slices), "whole": list(whole or {})}
        write_note(self.spark, f"{beside}/{READY}", json.dumps(note))
        self._move_in(dataset_id)

    def recover(self) -> list[str]:
        """End the commits of sessions that died while they moved folders; returns their datasets."""
        waiting = [n for n in list_paths(self.spark, self.path(BESIDE)) if self._note(n)]
        for name in waiting:
            self._move_in(name)
        return waiting

    def _beside(self, dataset_id: str) -> str:
        return f"{self.root}/{BESIDE}/{dataset_id}"

    def _note(self, dataset_id: str) -> dict | None:
        text = read_note(self.spark, f"{self._beside(dataset_id)}/{READY}")
        return json.loads(text) if text else None

    def _move_in(self, dataset_id: str) -> None:
        """Move what a commit has written into place; a second run goes on where the first one ended."""
        note, beside = self._note(dataset_id), self._beside(dataset_id)
        for table in note["whole"]:
            self._swap(f"{beside}/{table}", self.path(table))
        slice_ = f"{PARTITION}={dataset_id}"
        for table in (*PARTITIONED, *SIDE_TABLES):
            live = f"{self.path(table)}/{slice_}"
            written = table in note["slices"]
            if written and not path_exists(self.spark, f"{beside}/{table}"):
                continue  # moved by an earlier run
            if written and path_exists(self.spark, f"{beside}/{table}/{slice_}"):
                self._swap(f"{beside}/{table}/{slice_}", live)
            else:
                delete_path(self.spark, live)  # no rows, or no such table in this commit
            delete_path(self.spark, f"{beside}/{table}")
        delete_path(self.spark, beside)

    def _swap(self, written: str, live: str) -> None:
        if path_exists(self.spark, written):
            delete_path(self.spark, live)
            move_path(self.spark, written, live)

    def registry_row(self, meta: Mapping[str, str]) -> DataFrame:
        """The dataset's registry row, stamped with the current time."""
        names = ("dataset_id", "title", "version", "url")
        row = self.spark.createDataFrame(
            [tuple(meta.get(n) for n in names)], ", ".join(f"{n} string" for n in names)
        )
        return row.withColumn("extracted", F.current_timestamp())

    def register_dataset(self, meta: Mapping[str, str]) -> None:
        """Write the dataset's registry row."""
        self.replace_dataset(self.registry_row(meta), "datasets", meta["dataset_id"])

    def _side(self, table: str, schema: str) -> DataFrame:
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def rejects(self) -> DataFrame:
        """Rows that the declared rules kept out: dataset_id, table, reason, row (JSON)."""
        return self._side("rejects", REJECTS)

    def runs(self) -> DataFrame:
        """The ledger: one row per dataset that was ingested to its end, with the fingerprint of its input."""
        return self._side("runs", RUNS)

    def updated(self, table: str, changes: DataFrame, key: str, col: str) -> DataFrame:
        """The table with one column back-filled from (key, col) rows."""
        return back_filled(self.load(table), changes, key, col)

    def update_column(self, table: str, changes: DataFrame, key: str, col: str) -> None:
        """Back-fill one column of an unpartitioned table from (key, col) rows.

        The new table is written beside the old one and renamed into its place.
        """
        beside = f"{self.root}/{BESIDE}-{table}"
        delete_path(self.spark, beside)
        self._shaped(self.updated(table, changes, key, col), table).write.parquet(beside)
        self._swap(beside, self.path(table))

    def drop(self, table: str) -> None:
        """Remove the table and its files, if it is there."""
        delete_path(self.spark, self.path(table))

    def _writer(self, df: DataFrame, table: str):
        if table not in (*PARTITIONED, *SIDE_TABLES):
            return df.write
        if table in CLUSTERED:
            df = self.layout.cut(df, table, PARTITION, CLUSTERED[table])
        return df.write.partitionBy(PARTITION)


def back_filled(table: DataFrame, changes: DataFrame, key: str, col: str) -> DataFrame:
    """The frame with one column replaced where (key, col) rows have a value for it."""
    filled = lookup(table, changes, key, {col: "_new"})
    return filled.withColumn(col, F.coalesce("_new", col)).drop("_new")


def stage_view(df: DataFrame, name: str) -> DataFrame:
    """Give an intermediate frame a name for SQL, replacing an earlier one."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
