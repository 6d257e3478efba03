"""Files cut by place and season, bucketed joins, ids without a sort, rules on what is added, records in pieces."""

import random

import pytest
from pyspark.sql import functions as F

from fieldstar.operators import keys, textrepair
from fieldstar.operators.constraints import check_constraints
from fieldstar.operators.increments import check_increment, key_filter, maybe_known, with_keys_added
from fieldstar.plans import reports
from fieldstar.plans.checklists import event_keys
from fieldstar.plans.sketches import audit_sketches, merged_sketches, sketched_totals
from fieldstar.schema import SPLIT_TABLES, conform
from fieldstar.sinks.buckets import BucketedStar
from fieldstar.sinks.files import import_tables
from fieldstar.sinks.layout import BITS, Layout, cell, cell_ranges, day_number
from fieldstar.sinks.tables import Warehouse
from fieldstar.sources.text import with_row_order


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def star_rows(spark, n=6000):
    ids = spark.range(n)
    key = F.col("id")
    spread = lambda salt, m: F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(m))
    places = ids.select(
        key.alias("place_id"),
        (key % 2).cast("string").alias("dataset_id"),
        (spread(1, 3600) / 10 - 180).cast("double").alias("lng"),
        (spread(2, 1800) / 10 - 90).cast("double").alias("lat"),
    )
    events = ids.select(
        key.alias("event_id"),
        key.alias("place_id"),
        (key % 2).cast("string").alias("dataset_id"),
        (spread(3, 20) + 2000).cast("int").alias("year"),
        (spread(4, 366) + 1).cast("int").alias("day"),
        F.concat(F.lit('{"K":"v'), key.cast("string"), F.lit('"}')).alias("event_json"),
    )
    counts = spark.range(3 * n).select(
        key.alias("count_id"),
        (key % n).alias("event_id"),
        (key % n % 2).cast("string").alias("dataset_id"),
        F.lit(1).alias("taxon_id"),
        (key % 50).cast("int").alias("count"),
    )
    taxa = spark.createDataFrame([(1, "a", True, "aves")], "taxon_id long, sci_name string, target boolean, class string")
    return {"taxa": taxa, "places": places, "events": events, "counts": counts}


SLICE = (2014, (100, 300), (-73.0, -20.0), (10.0, 61.0))


def test_cells_hold_their_box(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(-180, 180), rng.uniform(-90, 90), rng.randrange(1890, 2110), rng.randrange(1, 367)) for _ in range(3000)]
    rows += [(-180.0, -90.0, 1900, 1), (180.0, 90.0, 2200, 366)]
    df = spark.createDataFrame(rows, "lng double, lat double, year int, day int")
    at = [r[0] for r in df.select(cell(F.col("lng"), F.col("lat"), F.col("year"), F.col("day"))).collect()]
    assert all(0 <= c < 1 << 3 * BITS for c in at)
    for _ in range(30):
        lng, lat = sorted(rng.uniform(-180, 180) for _ in "ab"), sorted(rng.uniform(-90, 90) for _ in "ab")
        year = rng.randrange(1895, 2105)
        days = sorted(rng.randrange(1, 367) for _ in "ab")
        ranges = cell_ranges(lng, lat, [day_number(year, d) for d in days])
        assert 0 < len(ranges) <= 32
        assert all(a <= b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
        for c, (x, y, yr, d) in zip(at, rows):
            if lng[0] <= x <= lng[1] and lat[0] <= y <= lat[1] and yr == year and days[0] <= d <= days[1]:
                assert any(a <= c <= b for a, b in ranges)
    assert df.select(cell(F.lit(None).cast("double"), F.col("lat"), F.col("year"), F.col("day")).alias("c")).filter("c is not null").isEmpty()


def test_small_boxes_ask_for_a_small_part_of_the_curve():
    ranges = cell_ranges((-73, -72), (40, 41), [day_number(2014, d) for d in (100, 110)])
    assert sum(b - a + 1 for a, b in ranges) < (1 << 3 * BITS) / 10_000


def scanned(df, column):
    """Rows that the scan of a column has read."""
    df.collect()
    return [
        leaf.metrics().apply("numOutputRows").value()
        for leaf in leaves(df._jdf.queryExecution().executedPlan())
        if column in leaf.toString()
    ]


def leaves(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        plan = plan.plan()
    below = plan.children()
    if below.isEmpty():
        return [plan]
    return [leaf for i in range(below.length()) for leaf in leaves(below.apply(i))]


def test_a_slice_skips_files_of_other_places_and_seasons(spark, tmp_path, rows):
    tables = star_rows(spark)
    plain, cut = Warehouse(spark, f"{tmp_path}/plain"), Warehouse(spark, f"{tmp_path}/cut", Layout({"events": ["K"]}, True))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for warehouse in (plain, cut):
            for name, df in tables.items():
                warehouse.append(df, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    reopened = Warehouse(spark, f"{tmp_path}/cut")
    assert reopened.layout == Layout({"events": ["K"]}, True)
    expected = reports.slice_targets(plain.tables(), *SLICE)
    found = reports.slice_targets(reopened.tables(beside=True), *SLICE)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected) != []
    assert rows(reports.slice_targets(reopened.tables(), *SLICE)) == rows(expected)
    read = reports.slice_json(reopened.tables(beside=True), None, "K", "k", *SLICE)
    (counts,) = scanned(read, "count#")
    assert counts < tables["counts"].count() / 2
    assert "get_json_object" not in initial_plan(read)
    assert rows(read) == rows(reports.slice_json(plain.tables(), None, "K", "k", *SLICE))
    assert "get_json_object" in initial_plan(reports.slice_json(plain.tables(), None, "K", "k", *SLICE))


def test_a_commit_places_counts_by_its_own_events(spark, tmp_path, rows):
    tables = {t: df.filter("dataset_id = '0'") if t in SPLIT_TABLES else df for t, df in star_rows(spark, 500).items()}
    warehouse = Warehouse(spark, str(tmp_path), Layout({"events": ["K"]}, True))
    slices = {t: conform(tables[t], t) for t in SPLIT_TABLES}
    warehouse.commit("0", slices, {"taxa": conform(tables["taxa"], "taxa")})
    assert warehouse.load("counts", beside=True).filter("cell is null").isEmpty()
    both = warehouse.load("counts", True).join(warehouse.load("events", True).select("event_id", F.col("cell").alias("e")), "event_id")
    assert both.filter("cell <> e").isEmpty() and both.count() == tables["counts"].count()
    orphan = spark.createDataFrame([(1, -5, "0", 1, 2)], "count_id long, event_id long, dataset_id string, taxon_id long, count int")
    warehouse.append(orphan, "counts")
    assert warehouse.load("counts", beside=True).filter("cell is null").count() == 1
    whole = (2014, (1, 366), (-180.0, 180.0), (-90.0, 90.0))
    assert reports.slice_targets(warehouse.tables(True), *whole).count() == reports.slice_targets(warehouse.tables(), *whole).count()
    with pytest.raises(ValueError, match="another layout"):
        Warehouse(spark, str(tmp_path), Layout())


def test_event_keys_come_from_their_column(spark):
    events = spark.createDataFrame(
        [(1, '{"SAMPLING_EVENT_IDENTIFIER":"S1"}', "S1")],
        "event_id long, event_json string, event_json__SAMPLING_EVENT_IDENTIFIER string",
    )
    assert "get_json_object" not in initial_plan(event_keys(events))
    assert [tuple(r) for r in event_keys(events).collect()] == [("S1", 1)]


def test_bucketed_counts_are_not_moved(spark, tmp_path, rows):
    tables = star_rows(spark, 2000)
    BucketedStar(spark, str(tmp_path)).write(tables, 4)
    copy = BucketedStar(spark, str(tmp_path))
    spark.sql(f"drop table {copy._table('counts')}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables_ = copy.tables()
        joined = tables_["events"].filter("year = 2014").select("event_id", "day").join(
            tables_["counts"].select("event_id", "count"), "event_id"
        )
        assert "Exchange" not in initial_plan(joined)
        sliced = reports.slice_targets(tables_, *SLICE)
        text = initial_plan(sliced)
        below = text[: text.index("Bucketed: true")] if "Bucketed: true" in text else ""
        counts_scan = next(line for line in text.splitlines() if "FileScan" in line and "count_json" in line)
        depth = text.splitlines().index(counts_scan)
        above = [line for line in text.splitlines()[depth - 4 : depth]]
        assert "Bucketed: true" in counts_scan and not any("Exchange" in line for line in above) and below
        assert rows(sliced) == rows(reports.slice_targets({t: conform(df, t) for t, df in tables.items()}, *SLICE))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows(copy.volumes()) == [("counts", 6000), ("events", 2000), ("places", 2000)]


def in_files(spark, path, n=900, files=5):
    spark.range(0, n, 1, files).select("id", (F.col("id") % 7).alias("k")).write.parquet(path)
    return with_row_order(spark.read.parquet(path))


def test_ids_in_file_order_move_no_row(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (old, "2000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = in_files(spark, f"{tmp_path}/{size}").filter("k <> 3")
            names = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k long, name string")
            shaped = df.join(F.broadcast(names), "k")
            assert keys.in_file_order(shaped)
            found = keys.assign_ids(shaped, "row_id", 10, keys.FILE_ORDER)
            assert "rangepartitioning" not in initial_plan(found)
            got = sorted((r["id"], r["row_id"]) for r in found.collect())
            expected = [i for i in range(900) if i % 7 != 3 and i % 7 < 5]
            assert got == list(zip(expected, range(10, 10 + len(expected))))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rows_that_were_moved_are_sorted_again(spark, tmp_path):
    df = in_files(spark, str(tmp_path / "f")).repartition(3)
    assert not keys.in_file_order(df)
    found = keys.assign_ids(df, "row_id", 0, keys.FILE_ORDER)
    assert all(r["id"] == r["row_id"] for r in found.collect())
    with pytest.raises(ValueError, match="file order"):
        keys.assign_ids_in_place(df, "row_id", 0)


# Rules on increments


def test_filters_have_no_false_negatives_and_can_be_added_to(spark):
    known = key_filter(spark.range(0, 4000), "id", 8000)
    more = with_keys_added(known, spark.range(4000, 8000), "id")
    asked = spark.range(0, 40000).select(F.col("id").alias("_key"))
    first = {r[0] for r in maybe_known(asked, known).collect()}
    both = {r[0] for r in maybe_known(asked, more).collect()}
    assert first >= set(range(4000)) and both >= set(range(8000))
    assert len(both) < 8000 + 0.1 * 32000
    text = key_filter(spark.createDataFrame([("é",), (None,)], "k string"), "k", 1)
    asked = spark.createDataFrame([("é",), ("x",)], "_key string")
    assert [r[0] for r in maybe_known(asked, text).collect()] == ["é"]


@pytest.mark.parametrize("filtered", [True, False])
def test_increments_have_the_violations_of_the_whole(spark, filtered):
    tables = {t: conform(df, t) for t, df in star_rows(spark, 200).items()}
    datasets = spark.createDataFrame([("0", "t", "v"), ("1", "t", "v")], "dataset_id string, title string, version string")
    tables["datasets"] = conform(datasets, "datasets")
    assert check_constraints(tables).isEmpty()
    new = F.col("event_id") + 1000
    added = {
        "events": tables["events"].filter("event_id < 20").withColumn("event_id", F.when(F.col("event_id") > 3, new).otherwise(F.col("event_id")))
        .unionByName(tables["events"].filter("event_id = 30").withColumn("event_id", F.lit(1010).cast("long")))
        .withColumn("place_id", F.when(F.col("event_id") % 5 == 0, F.col("place_id") + 9999).otherwise(F.col("place_id")))
        .withColumn("year", F.when(F.col("event_id") % 7 > 0, F.col("year"))),
        "counts": tables["counts"].filter("count_id < 40").withColumn("count_id", F.col("count_id") + 5000)
        .withColumn("event_id", F.when(F.col("event_id") < 10, new).otherwise(F.col("event_id") + 180)),
        "taxa": tables["taxa"].withColumn("taxon_id", F.lit(2).cast("long")),
    }
    columns = {"events": ["event_id"], "counts": ["count_id"], "taxa": ["taxon_id", "sci_name"], "places": ["place_id"]}
    filters = {t: {c: key_filter(tables[t], c, 1000) for c in cs} for t, cs in columns.items()} if filtered else {}
    found = check_increment(tables, added, filters)
    whole = check_constraints({t: df.unionByName(added[t]) if t in added else df for t, df in tables.items()})
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert found.count() > 10
    clean = {"places": tables["places"].withColumn("place_id", F.col("place_id") + 10**6)}
    assert check_increment(tables, clean, filters).isEmpty()


def test_sketches_merge(spark):
    def seen(start, many):
        key = F.col("id")
        return spark.range(start, start + many).select(
            (key % 20000 / 100).alias("LONGITUDE"),
            (key % 7).cast("double").alias("LATITUDE"),
            key.cast("string").alias("SAMPLING_EVENT_IDENTIFIER"),
            F.when(key % 2 == 0, "a").otherwise("b").alias("SCIENTIFIC_NAME"),
            F.make_date(F.lit(2000) + (key % 3).cast("int"), F.lit(1), F.lit(2)).alias("date"),
        )

    targets = spark.createDataFrame([("a",), ("a",)], "sci_name string")
    parts = [audit_sketches(seen(s, 30000), targets, F.lit("d")) for s in (0, 20000)]
    merged = merged_sketches(parts[0].unionByName(parts[1]))
    assert merged.count() == 3
    total = sketched_totals(merged).first()
    whole = sketched_totals(audit_sketches(seen(0, 50000), targets, F.lit("d"))).first()
    assert (total["places"], total["events"]) == (whole["places"], whole["events"])
    assert abs(total["events"] / 50000 - 1) < 0.033 and total["counts"] == 30000
    by_year = {r["year"]: r["events"] for r in sketched_totals(merged, "year").collect()}
    assert all(abs(n / (50000 / 3) - 1) < 0.033 for n in by_year.values())
    empty = sketched_totals(merged.limit(0)).first()
    assert tuple(empty) == (0, 0, 0)


# Records in pieces


def test_a_quote_that_never_closes_costs_pieces(spark):
    """A million lines behind one unclosed record come out whole, none of its rows longer than a piece."""
    many = 1_000_000
    text = F.when(F.col("id") == 0, "'1','ok','x'").when(F.col("id") == 1, "'2','open")
    text = text.otherwise(F.concat(F.lit("line "), F.col("id").cast("string")))
    lines = spark.range(many).select(F.lit("f").alias("file"), F.col("id").alias("line_no"), text.alias("text"))
    made = textrepair.assemble_records(lines, 3)
    sizes = made.select("record", "piece", F.size(F.split("text", "\n")).alias("n"), F.xxhash64("text").alias("h"))
    found = sorted((r["record"], r["piece"], r["n"]) for r in sizes.collect())
    assert found[0] == (1, 0, 1)
    pieces = found[1:]
    assert {r for r, _, _ in pieces} == {2} and [p for _, p, _ in pieces] == list(range(len(pieces)))
    assert sum(n for _, _, n in pieces) == many - 1
    assert max(n for _, _, n in pieces) == textrepair.PIECE_LINES


def test_pieces_put_together_are_the_record(spark, monkeypatch):
    lines = [f"x{i}" for i in range(10)]
    rows = [("f", i, 1 + (i >= 7), t) for i, t in enumerate(lines)]
    df = spark.createDataFrame(rows, "file string, line_no long, record long, text string")
    found = {(r["record"], r["piece"]): r["text"] for r in textrepair.join_pieces(df, 3).collect()}
    assert found == {(1, 0): "x0\nx1\nx2", (1, 1): "x3\nx4\nx5", (1, 2): "x6", (2, 0): "x7\nx8\nx9"}


def test_an_import_with_a_broken_record_raises(spark, tmp_path):
    folder = tmp_path / "taxa.csv"
    folder.mkdir()
    good = '1,a,,,,,,"line\r\none ""q""",,,true,,""\n'
    (folder / "part.csv").write_bytes(good.encode() * 40)
    rows = import_tables(spark, str(tmp_path), {"taxa": ["taxa.csv"]})["taxa"].collect()
    assert len(rows) == 40 and {(r["common_name"], r["target"], r["taxon_json"], r["spec"]) for r in rows} == {
        ('line\r\none "q"', True, "", None)
    }
    (folder / "bad.csv").write_text('2,b,"never closed\n3,c\n')
    with pytest.raises(ValueError, match="another width"):
        import_tables(spark, str(tmp_path), {"taxa": ["taxa.csv"]})
