"""Streams that carry state, commits that hold, and runs that go on."""

import pytest
from pyspark.sql import functions as F
from test_plans import CHECKLIST_HEADER, ORDER, raw, sources

from fieldstar.operators.constraints import check_constraints
from fieldstar.plans import run_all as runs
from fieldstar.plans.checklists import checklists
from fieldstar.plans.run_all import PLANS, fingerprint, ingest, run_all
from fieldstar.session import list_paths, path_exists, read_note, write_note
from fieldstar.sinks import tables as tables_module
from fieldstar.sinks.tables import BESIDE, Warehouse
from fieldstar.streaming import ingest as streams
from fieldstar.streaming import star as star_module
from fieldstar.streaming.star import StreamedStar, stream_checklists


def arrive(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def observed(spark, start, many):
    lines = [
        f"u{i},S{i // 3},{['Larus argentatus', 'Ammospiza nelsoni', 'Corvus corax'][i % 3]},"
        f"-7{i % 4}.5,40.5,2014-04-{10 + i % 9},{'lots' if i % 10 == 9 else i},1,1,1.5,23:30:00,90"
        for i in range(start, start + many)
    ]
    return raw(spark, CHECKLIST_HEADER, *lines).withColumn("ord", F.col("ord") + start)


def taxonomy(spark):
    rows = [(1, "Larus argentatus", "aves", True), (2, "Ammospiza nelsoni", "aves", True), (3, "Corvus corax", "aves", False)]
    return spark.createDataFrame(rows, "taxon_id long, sci_name string, class string, target boolean")


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("in", "out", "progress")]


def streamed(spark, folders, taxa):
    source, target, progress = folders
    stream = streams.stream_files(spark, source, observed(spark, 0, 1).schema, "parquet", 1)
    query = stream_checklists(stream, target, progress, taxa, ORDER)
    query.awaitTermination()
    assert query.exception() is None
    return StreamedStar(spark, target)


def whole(tables):
    return {t: sorted((tuple(r) for r in df.collect()), key=repr) for t, df in tables.items()}


def test_streamed_star_is_the_batch_star(spark, folders, tmp_path):
    taxa = taxonomy(spark)
    parts = [observed(spark, 0, 20), observed(spark, 20, 0), observed(spark, 14, 25), observed(spark, 39, 8)]
    # The third file repeats observations of the first: keys are known, counts come again.
    parts[2] = parts[2].withColumn("ord", F.col("ord") + 100)
    parts[3] = parts[3].withColumn("ord", F.col("ord") + 200)
    for part in parts[:2]:
        arrive(part, folders[0])
    streamed(spark, folders, taxa)
    for part in parts[2:]:
        arrive(part, folders[0])
    star = streamed(spark, folders, taxa)
    empty = Warehouse(spark, str(tmp_path / "none")).tables()
    union = parts[0].unionByName(parts[2]).unionByName(parts[3])
    batch = checklists(spark, {"checklists": union}, {**empty, "taxa": taxa}, ORDER)
    assert whole({**star.tables(), "rejects": star.load("rejects")}) == whole(batch)
    assert len(star.commits()) == 3
    assert star.next_ids(99, {}) == {"places": 5, "events": 17, "counts": 37}


def test_a_batch_that_died_or_comes_again_changes_nothing(spark, folders, monkeypatch):
    taxa = taxonomy(spark).filter("target").select("sci_name", "taxon_id")
    star, start = StreamedStar(spark, folders[1]), {"places": 5, "events": 100, "counts": 1000}
    add = lambda df, batch: star.add(df, batch, taxa, ORDER, start, "ebird")
    add(observed(spark, 0, 12), 0)
    once = whole(star.tables())
    assert min(r[0] for r in once["events"]) == 100
    monkeypatch.setattr(star_module, "write_note", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        add(observed(spark, 9, 12), 1)
    assert whole(star.tables()) == once
    monkeypatch.undo()
    add(observed(spark, 9, 12), 1)
    twice = whole(star.tables())
    assert [r[0] for r in twice["events"]] == list(range(100, 107))
    add(observed(spark, 50, 12), 1)
    add(observed(spark, 0, 12), 0)
    assert whole(star.tables()) == twice


def test_streamed_star_published(spark, folders, tmp_path):
    arrive(observed(spark, 0, 30), folders[0])
    star = streamed(spark, folders, taxonomy(spark))
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.append(taxonomy(spark), "taxa")
    star.publish(warehouse)
    star.publish(warehouse)
    assert warehouse.load("counts").count() == star.load("counts").count() > 0
    assert warehouse.rejects().count() == star.load("rejects").count() > 0
    assert check_constraints(warehouse.tables()).count() == 0


ODD = "k1 string, k2 long, ord struct<a:long,b:timestamp>, v double, d decimal(20,3), b binary, l array<string>, t timestamp_ntz"


def odd_rows(spark, *rows):
    made = spark.createDataFrame([(k1, k2, a, s) for k1, k2, a, s in rows], "k1 string, k2 long, a long, s string")
    return made.select(
        "k1",
        "k2",
        F.struct("a", F.lit("2020-01-01 00:00:00.123456").cast("timestamp").alias("b")).alias("ord"),
        F.lit(float("nan")).alias("v"),
        F.lit("12345678901234567.125").cast("decimal(20,3)").alias("d"),
        F.col("s").cast("binary").alias("b"),
        F.array("s", F.lit(None)).alias("l"),
        F.lit("2021-05-05 01:02:03.000007").cast("timestamp_ntz").alias("t"),
    )


def test_first_seen_keeps_every_value(spark, folders):
    """NULL keys and orders, numbers no double holds, and values of every kind come through whole."""
    source, target, progress = folders
    big = (1 << 60) + 1
    batches = [
        [("a", 1, big + 1, "later"), ("a", 1, big, "first"), (None, 1, 5, "null key"), ("a", None, None, "null order")],
        [("a", 1, 0, "known"), (None, 1, 1, "known"), ("a", None, 7, "known"), ("c", 9, 2, "x"), ("c", 9, None, "y")],
    ]
    for rows in batches:
        arrive(odd_rows(spark, *rows), source)
    schema = odd_rows(spark, *batches[0]).schema
    stream = streams.stream_files(spark, source, schema, "parquet", 1)
    query = streams.stream_first_seen(stream, target, progress, ["k1", "k2"], ["ord"])
    query.awaitTermination()
    assert query.exception() is None
    found = streams.read_target(spark, target, schema).drop(streams.BATCH)
    expected = odd_rows(spark, batches[0][1], batches[0][2], batches[0][3], batches[1][4])
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    state = query.lastProgress["stateOperators"][0]
    assert "RocksDB" in str(state["customMetrics"]) or any("rocksdb" in k.lower() for k in state["customMetrics"])


def test_first_seen_refuses_orders_it_cannot_compare(spark, folders):
    schema = spark.createDataFrame([], "k int, o array<int>").schema
    with pytest.raises(TypeError, match="cannot be ordered by o"):
        streams._sortable(schema, "o")


# Commits


def put(spark, warehouse, n, name="bbs"):
    places = spark.createDataFrame([(i, 1.0, 2.0) for i in range(n)], "place_id long, lng double, lat double")
    events = places.select(F.col("place_id").alias("event_id"), "place_id", F.lit(2000).alias("year"), F.lit(1).alias("day"))
    counts = events.select(F.col("event_id").alias("count_id"), "event_id", F.lit(1).alias("taxon_id"), F.lit(n).alias("count"))
    taxa = spark.createDataFrame([(1, f"taxon of {n}")], "taxon_id long, sci_name string")
    slices = {"places": places, "events": events, "counts": counts}
    warehouse.commit(name, slices, {"taxa": taxa})


def state(warehouse):
    volumes = tuple(warehouse.load(t).count() for t in ("places", "events", "counts"))
    return (*volumes, warehouse.load("taxa").first()["sci_name"])


@pytest.mark.parametrize("failing", [1, 2, 3, 4])
def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch, failing):
    warehouse = Warehouse(spark, str(tmp_path))
    put(spark, warehouse, 3)
    assert state(warehouse) == (3, 3, 3, "taxon of 3")
    real, calls = Warehouse._shaped, []

    def breaks(self, df, table, *rest):
        calls.append(table)
        if len(calls) == failing:
            raise OSError("disk full")
        return real(self, df, table, *rest)

    monkeypatch.setattr(Warehouse, "_shaped", breaks)
    with pytest.raises(OSError, match="disk full"):
        put(spark, warehouse, 5)
    monkeypatch.undo()
    assert state(warehouse) == (3, 3, 3, "taxon of 3")
    put(spark, warehouse, 5)
    assert state(warehouse) == (5, 5, 5, "taxon of 5")


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_a_commit_that_dies_among_its_renames_is_ended_later(spark, tmp_path, monkeypatch, moves):
    warehouse = Warehouse(spark, str(tmp_path))
    put(spark, warehouse, 3)
    real, calls = tables_module.move_path, []

    def dies(*args):
        if len(calls) == moves:
            raise OSError("session lost")
        calls.append(args)
        real(*args)

    monkeypatch.setattr(tables_module, "move_path", dies)
    with pytest.raises(OSError, match="session lost"):
        put(spark, warehouse, 5)
    monkeypatch.undo()
    again = Warehouse(spark, str(tmp_path))
    assert again.recover() == ["bbs"]
    assert state(again) == (5, 5, 5, "taxon of 5")
    assert again.recover() == []
    assert not list_paths(spark, f"{tmp_path}/{BESIDE}")


def test_a_commit_drops_what_it_does_not_bring_and_leaves_other_datasets(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    put(spark, warehouse, 3)
    put(spark, warehouse, 4, "maps")
    empty = warehouse.load("places").limit(0)
    warehouse.commit("bbs", {"places": empty})
    assert {r[0] for r in warehouse.load("counts").select("dataset_id").distinct().collect()} == {"maps"}
    assert state(warehouse)[:3] == (4, 4, 4)


def test_taxonomy_survives_a_failed_update(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    put(spark, warehouse, 1)
    changes = spark.createDataFrame([(1, "{}")], "taxon_id long, taxon_json string")
    monkeypatch.setattr(tables_module, "move_path", lambda *_: 1 / 0)
    monkeypatch.setattr(tables_module, "delete_path", lambda *_: None)
    with pytest.raises(ZeroDivisionError):
        warehouse.update_column("taxa", changes, "taxon_id", "taxon_json")
    monkeypatch.undo()
    assert warehouse.load("taxa").first()["taxon_json"] is None
    warehouse.update_column("taxa", changes, "taxon_id", "taxon_json")
    assert warehouse.load("taxa").first()["taxon_json"] == "{}"


def test_notes(spark, tmp_path):
    path = f"{tmp_path}/deep/note"
    assert read_note(spark, path) is None
    for text in ("one", "two, é"):
        write_note(spark, path, text)
        assert read_note(spark, path) == text
    assert list_paths(spark, f"{tmp_path}/deep") == ["note"]
    assert path_exists(spark, path)


# The ledger


def test_a_killed_run_goes_on(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    ran = []

    def noted(name, plan):
        def run(*args, **kw):
            ran.append(name)
            return plan(*args, **kw)

        return run

    plans = dict(PLANS)
    for name, plan in plans.items():
        monkeypatch.setitem(PLANS, name, noted(name, plan))
    monkeypatch.setitem(PLANS, "nestwatch", lambda *_, **__: 1 / 0)
    given = {k: v for k, v in sources(spark).items() if k in ("clements", "bbs", "nestwatch", "pollard")}
    run = lambda **kw: run_all(spark, warehouse, given, as_of_year=2020, order=ORDER, resume=True, **kw)
    with pytest.raises(ZeroDivisionError):
        run()
    assert ran == ["clements", "bbs"]
    monkeypatch.setitem(PLANS, "nestwatch", noted("nestwatch", plans["nestwatch"]))
    made = run()
    assert ran == ["clements", "bbs", "nestwatch", "pollard"]
    assert made["bbs"]["counts"].count() == 2
    assert {r["dataset_id"] for r in warehouse.runs().collect()} == set(given)
    run()
    assert len(ran) == 4
    # Another input runs again, and so does what comes after it.
    given["nestwatch"] = {"attempts": given["nestwatch"]["attempts"].filter("ord < 2")}
    run()
    assert ran[4:] == ["nestwatch", "pollard"]
    run_all(spark, warehouse, given, as_of_year=2020, order=ORDER)
    assert len(ran) == 10
    assert check_constraints(warehouse.tables()).count() == 0


def test_fingerprints(spark, tmp_path):
    path = str(tmp_path / "files")
    frame = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    known = fingerprint({"x": frame})
    assert known == fingerprint({"x": frame.orderBy(F.desc("k"))})
    assert known != fingerprint({"x": frame.withColumn("v", F.lit("a"))})
    assert known != fingerprint({"y": frame})
    assert known != fingerprint({"x": frame}, "before")
    frame.write.parquet(path)
    read = lambda: {"x": spark.read.parquet(path)}
    first = fingerprint(read())
    assert first == fingerprint(read())
    assert first != fingerprint({"x": spark.read.parquet(path).filter("k > 1")})
    frame.write.mode("append").parquet(path)
    assert first != fingerprint(read())


def test_ingest_alone_leaves_no_ledger_row(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    ingest(spark, warehouse, "clements", sources(spark)["clements"], order=ORDER)
    assert warehouse.runs().count() == 0
    assert runs.stored_rows(warehouse, "clements")["rejects"].count() == 0
