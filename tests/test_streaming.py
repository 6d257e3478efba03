import pytest

from fieldstar.operators.keys import first_seen
from fieldstar.plans.reports import bbox_extract
from fieldstar.streaming import ingest

OBS = (
    "GLOBAL_UNIQUE_IDENTIFIER string, SAMPLING_EVENT_IDENTIFIER string, SCIENTIFIC_NAME string, LONGITUDE string, "
    "LATITUDE string, OBSERVATION_DATE string, OBSERVATION_COUNT string, APPROVED string, ALL_SPECIES_REPORTED string"
)


def observations(spark, *rows):
    return spark.createDataFrame([(u, s, n, "-70", lat, "2014-04-10", c, "1", "1") for u, s, n, lat, c in rows], OBS)


def arrive(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("in", "out", "progress")]


def run(start):
    query = start()
    query.awaitTermination()
    assert query.exception() is None


def test_first_seen_over_batches_and_restarts(spark, folders, rows):
    source, target, progress = folders
    schema = "k int, ord int"
    arrive(spark.createDataFrame([(1, 5), (1, 4), (2, 1)], schema), source)

    def start():
        stream = ingest.stream_files(spark, source, spark.createDataFrame([], schema).schema, "parquet", 1)
        return ingest.stream_first_seen(stream, target, progress, ["k"], ["ord"])

    run(start)
    assert rows(spark.read.parquet(target), "k", "ord") == [(1, 4), (2, 1)]
    arrive(spark.createDataFrame([(1, 1), (3, 9)], schema), source)
    arrive(spark.createDataFrame([], schema), source)
    run(start)
    run(start)
    assert rows(spark.read.parquet(target), "k", "ord") == [(1, 4), (2, 1), (3, 9)]


def test_a_replayed_batch_changes_nothing(spark, folders, rows):
    target = folders[1]
    first = spark.createDataFrame([(1, 1), (2, 2)], "k int, ord int")

    def step(df, batch_id):
        seen = ingest._before(spark, target, df.schema, batch_id)
        ingest._write(first_seen(df, seen, ["k"], ["ord"]), target, batch_id)

    step(first.limit(1), 0)  # a first attempt that died half way
    step(first, 0)
    step(first, 0)
    step(first.union(spark.createDataFrame([(3, 3)], "k int, ord int")), 1)
    assert rows(spark.read.parquet(target), "k", "ord") == [(1, 1), (2, 2), (3, 3)]


def test_stream_extract_equals_batch_extract(spark, folders, rows):
    source, target, progress = folders
    df = observations(spark, ("a", "S1", "x", "40", "1"), ("b", "S1", "x", "80", "1"), (None, "S1", "x", "40", "1"))
    arrive(df, source)
    stream = ingest.stream_files(spark, source, df.schema, "parquet")
    run(lambda: ingest.stream_bbox(stream, target, progress, (-80.0, -60.0), (30.0, 50.0)))
    batch = bbox_extract(df, (-80.0, -60.0), (30.0, 50.0))
    assert rows(spark.read.parquet(target), *df.columns) == rows(batch, *df.columns)


def test_backfill_only_known_events(spark, folders, rows):
    source, target, progress = folders
    df = observations(spark, ("a", "S1", "rare", "40", "X"), ("b", "S9", "rare", "40", "1"), ("c", "S1", "common", "40", "1"))
    arrive(df, source)
    events = spark.createDataFrame([(7, '{"SAMPLING_EVENT_IDENTIFIER":"S1"}')], "event_id long, event_json string")
    taxa = spark.createDataFrame([(3, "rare"), (4, "common")], "taxon_id long, sci_name string")
    stream = ingest.stream_files(spark, source, df.schema, "parquet")
    run(lambda: ingest.stream_backfill(stream, target, progress, events, taxa, ["rare"]))
    assert rows(spark.read.parquet(target), "event_id", "taxon_id", "count") == [(7, 3, -1)]
    assert rows(spark.read.parquet(target), "count_id", "dataset_id") == [(1, "ebird")]
    more = observations(spark, ("e", "S1", "rare", "40", "5"), ("d", "S1", "rare", "40", "4"))
    arrive(more, source)
    run(lambda: ingest.stream_backfill(stream, target, progress, events, taxa, ["rare"]))
    assert rows(spark.read.parquet(target), "count_id", "count") == [(1, -1), (2, 4), (3, 5)]


def test_empty_batches_are_skipped(spark):
    assert ingest.skip_if_empty(spark.range(0)) and not ingest.skip_if_empty(spark.range(1))
    assert ingest.read_target(spark, "/tmp/no/such/folder", spark.range(1).schema).count() == 0


def test_batches_that_keep_no_row(spark, folders, rows):
    target, none = folders[1], spark.createDataFrame([], "k int, ord int")
    ingest._write(none, target, 0)
    assert ingest._before(spark, target, none.schema, 1).count() == 0
