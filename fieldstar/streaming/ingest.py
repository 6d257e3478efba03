"""Incremental ingest of append-only raw files with Structured Streaming.

A batch writes into its own `batch_id` partition and overwrites it, so a batch
that is replayed after a failure leaves the table as if it had run once. Which
keys have been seen is kept in Spark's state store, on disk: a batch costs what
its own rows cost, however much was written before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldstar.operators.filters import extract_bbox
from fieldstar.operators.keys import assign_ids, next_id
from fieldstar.plans.checklists import backfill_rows, event_keys
from fieldstar.plans.common import tagged
from fieldstar.schema import SCHEMAS, conform
from fieldstar.session import path_exists, stage

BATCH = "batch_id"


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", files_per_batch: int | None = None, **options
) -> DataFrame:
    """Streaming scan of a folder that only ever gains files."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def skip_if_empty(df: DataFrame) -> bool:
    """Whether a batch brings nothing to do."""
    return df.isEmpty()


def read_target(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Everything a stream has written so far, with its batch; empty before the first row."""
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, target):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(target)


def _before(spark: SparkSession, target: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """What earlier batches wrote."""
    return read_target(spark, target, schema).filter(F.col(BATCH) < batch_id)


def _write(df: DataFrame, target: str, batch_id: int) -> None:
    writer = df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").partitionBy(BATCH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(target)


def stream_ingest(
    source: DataFrame, target: str, checkpoint: str, step: Callable[[DataFrame, int], DataFrame], mode: str = "append"
) -> StreamingQuery:
    """Run a step on every micro-batch and keep its rows, until the input is used up.

    A frame that keeps state (mode `update`) is worked out by its write alone,
    not by a look at whether it is empty before that.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        if mode == "update" or not skip_if_empty(df):
            _write(step(df, batch_id), target, batch_id)

    writer = source.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


ORDERED = (
    T.StringType,
    T.BooleanType,
    T.IntegralType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _sortable(schema: T.StructType, name: str) -> list[Column]:
    """Columns without NULLs that sort like the given one (NULL first), structs field by field."""

    def parts(kind: T.DataType, c: Column) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [c.isNotNull(), *[p for f in kind.fields for p in parts(f.dataType, c[f.name])]]
        if not isinstance(kind, ORDERED):
            raise TypeError(f"rows cannot be ordered by {name}: {kind.simpleString()}")
        least = F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast("int").cast("boolean")
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c, least = F.unix_micros(c.cast("timestamp")), F.lit(0).cast("long")
        elif not isinstance(kind, (T.StringType, T.BooleanType)):
            least = F.lit(0).cast(kind)
        return [c.isNotNull(), F.coalesce(c, least)]

    return parts(schema[name].dataType, F.col(f"`{name}`"))


ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def new_keys(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Streaming frame, in update mode, of the first row (by `order`, within its batch) of every key no earlier batch has brought.

    A built-in aggregation: map tasks send one row per key, so a key that holds
    a third of a batch costs no more than any other. The state is a key's first
    row and the times of the first and last batch that brought it, which are
    the same for a new key only. A batch's time is part of its offsets: one
    that runs again has the time it had. NULL is a key like any other.
    """
    parts = [p for c in order for p in _sortable(source.schema, c)]
    timed = source.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        F.struct("*").alias("_row"),
        F.struct(F.current_timestamp(), *parts).alias("_at"),
        F.current_timestamp().alias("_time"),
    )
    found = timed.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
        F.min_by("_row", "_at").alias("_r"), F.min("_time").alias("_born"), F.max("_time").alias("_met")
    )
    return found.filter("_born = _met").select("_r.*")


def stream_first_seen(
    source: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """First row per key over all batches; later rows of a known key are dropped.

    "First" is by batch, and within a batch by `order`.
    """
    spark = source.sparkSession
    if spark.conf.get(STATE_STORE, "") != ROCKS_DB:
        spark.conf.set(STATE_STORE, ROCKS_DB)
    return stream_ingest(new_keys(source, keys, order), target, checkpoint, lambda df, _: df, "update")


def stream_bbox(source: DataFrame, target: str, checkpoint: str, lng: tuple, lat: tuple, **clauses: bool) -> StreamingQuery:
    """Stateless extract: rows inside the box go straight to the sink."""
    rows = extract_bbox(source, lng, lat, **clauses)
    writer = rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(target)


def stream_backfill(
    source: DataFrame,
    target: str,
    checkpoint: str,
    events: DataFrame,
    taxa: DataFrame,
    names: Sequence[str],
    start: int = 1,
    dataset_id: str = "ebird",
    order: Sequence[str] = ("GLOBAL_UNIQUE_IDENTIFIER",),
) -> StreamingQuery:
    """Counts of missed species, only for checklists that are already events, ready to be appended.

    The events' keys are parsed once for the whole stream. Count ids go on
    from `start`, a batch from the last id of the batches before it, in the
    given row order; a batch that is run again gets the same ids.
    """
    known = stage(event_keys(events), "event-keys")

    def step(df: DataFrame, batch_id: int) -> DataFrame:
        earlier = _before(df.sparkSession, target, SCHEMAS["counts"], batch_id)
        first = max(start, next_id(earlier, "count_id"))
        rows = assign_ids(backfill_rows(df, known, taxa, names), "count_id", first, order)
        return conform(tagged(rows, dataset_id), "counts")

    return stream_ingest(source, target, checkpoint, step)
