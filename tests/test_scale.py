"""Plans must be the ones that hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from fieldstar.operators import aggregates, joins, keys
from fieldstar.plans import reports
from fieldstar.schema import conform
from fieldstar.session import staging_dir
from fieldstar.sinks.tables import Warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("star")))
    n = spark.range(0, 20000)
    places = n.select(
        F.col("id").alias("place_id"),
        (F.col("id") % 3).cast("string").alias("dataset_id"),
        (F.col("id") % 360 - 180).cast("double").alias("lng"),
        (F.col("id") % 180 - 90).cast("double").alias("lat"),
    )
    events = n.select(
        F.col("id").alias("event_id"),
        F.col("id").alias("place_id"),
        (F.col("id") % 3).cast("string").alias("dataset_id"),
        (F.col("id") % 20 + 2000).cast("int").alias("year"),
        (F.col("id") % 366).cast("int").alias("day"),
        F.lit('{"K":"v"}').alias("event_json"),
    )
    counts = n.select(F.col("id").alias("event_id"), F.lit(1).alias("taxon_id"), F.lit("0").alias("dataset_id"))
    taxa = spark.createDataFrame([(1, "a", True)], "taxon_id long, sci_name string, target boolean")
    for table, df in {"places": places, "events": events, "counts": counts, "taxa": taxa}.items():
        warehouse.append(conform(df, table), table)
    return warehouse.tables()


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keys.first_per_key(df, ["k"], ["id"]))
    below = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_slices_push_filters_and_prune_columns(star):
    df = reports.slice_json(star, "1", "K", "k", 2014, (100, 110), (-73.0, -72.0), (40.0, 41.0))
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(lng,-73.0)" in text and "LessThanOrEqual(day,110)" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(dataset_id#\d+\), \(dataset_id#\d+ = 1\)\]", text)
    assert "place_json" not in text and "count_json" not in text and "geopoint" not in text


def test_reductions_happen_before_the_joins(spark):
    bands = spark.createDataFrame([], "STA string, NET string, DATE string, STATION string")
    effort = spark.createDataFrame([], "STA string, NET string, DATE string, START string, END string, LENGTH string")
    stations = spark.createDataFrame([], "STA string, place_id long")
    text = plan(aggregates.effort_events(bands, effort, stations, stations.select("place_id")))
    assert "partial_max" in text and "partial_min" in text


def test_hot_key_is_split_and_whole(spark):
    """One key holds a third of the rows: the runtime splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = F.col("id")
        facts = spark.range(0, 60000, 1, 8).select(F.when(n % 3 == 0, 7).otherwise(n % 1000).alias("k"), "id")
        dim = spark.range(0, 1000).select(n.alias("k"), (n * 2).alias("v"))
        out = joins.lookup(facts, dim, "k", ["v"])
        assert len(out.collect()) == 60000
        assert "skew=true" in plan(out)
        assert out.filter("v is null or v <> k * 2").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_only_bounded_tables_are_hinted_into_a_broadcast():
    import pathlib

    package = pathlib.Path(keys.__file__).parents[1]
    banned = ("localCheckpoint", "crossJoin", "toPandas(", ".rdd.map")
    assert [p for p in package.rglob("*.py") if any(b in p.read_text() for b in banned)] == []
    core = [p for p in package.rglob("*.py") if p.parent.name != "llm"]
    hints = [p for p in core if "broadcast(" in p.read_text()]
    assert [p.name for p in hints] == ["keys.py"]  # offsets: one row per partition


def test_slices_of_one_dataset_prune_all_three_tables(spark, tmp_path):
    from fieldstar.plans.reports import slice_json
    from fieldstar.schema import SCHEMAS
    from fieldstar.sinks.tables import Warehouse

    warehouse = Warehouse(spark, str(tmp_path))
    for table in ("places", "events", "counts"):
        for name in ("a", "b"):
            warehouse.replace_dataset(spark.createDataFrame([], SCHEMAS[table]).unionByName(
                spark.range(1).select(F.lit(name).alias("dataset_id")), allowMissingColumns=True), table, name)
    df = slice_json(warehouse.tables(), "a", "K", "k", 2000, (1, 9), (-1.0, 1.0), (-1.0, 1.0))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len([s for s in scans if "PartitionFilters: [isnotnull(dataset_id" in s]) == 3


def test_ingest_leaves_no_staged_folders_and_stores_rejects(spark, tmp_path):
    import os

    from fieldstar.operators.constraints import check_constraints
    from fieldstar.plans.run_all import PLANS, ingest
    from fieldstar.schema import conform
    from fieldstar.session import stage
    from fieldstar.sinks.tables import Warehouse

    folder = staging_dir(spark)
    before = set(os.listdir(folder))

    def plan(spark, raw, tables):
        places = stage(raw["p"])
        return {"places": places, "events": raw["e"], "counts": raw["c"], "taxa": raw["t"]}

    raw = {
        "p": spark.createDataFrame([(1, 2.0, 3.0), (2, None, 3.0)], "place_id long, lng double, lat double"),
        "e": spark.createDataFrame([(1, 1, 2000, 5), (2, 2, 2000, 5), (3, 1, None, 5)], "event_id long, place_id long, year int, day int"),
        "c": spark.createDataFrame([(1, 1, 1, 4), (2, 1, 1, None), (3, 2, 1, 4), (4, 3, 1, 4)], "count_id long, event_id long, taxon_id long, count int"),
        "t": spark.createDataFrame([(1, "x")], "taxon_id long, sci_name string"),
    }
    names = {"p": "places", "e": "events", "c": "counts", "t": "taxa"}
    raw = {k: conform(df.withColumn("dataset_id", F.lit("bbs")), names[k]) for k, df in raw.items()}
    warehouse, old = Warehouse(spark, str(tmp_path)), PLANS["bbs"]
    PLANS["bbs"] = plan
    try:
        stored = ingest(spark, warehouse, "bbs", raw)
        assert set(os.listdir(folder)) == before
        got = sorted((r["table"], r["reason"]) for r in stored["rejects"].collect())
        assert got == [
            ("counts", "count"), ("counts", "events was rejected"), ("counts", "events was rejected"),
            ("events", "places was rejected"), ("events", "year"), ("places", "lng"),
        ]
        assert check_constraints(warehouse.tables()).count() == 0
        PLANS["bbs"] = lambda *_: 1 / 0
        with pytest.raises(ZeroDivisionError):
            ingest(spark, warehouse, "bbs", raw)
        assert warehouse.load("counts").count() == 1
        assert set(os.listdir(folder)) == before
    finally:
        PLANS["bbs"] = old


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert staging_dir(Session()) == "hdfs:///shared"
