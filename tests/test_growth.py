"""What must not grow with the input: work per key outside the engine, rows per file and task, tasks per byte."""

from checks import all_queries  # noqa: F401 (views first)
from pyspark.sql import functions as F

from fieldstar.streaming import ingest


def test_first_seen_keys_are_kept_by_the_engine(spark, tmp_path):
    """no Python call per key, and a row that orders before a known key's stays out."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in ([(0.5, 3, "b"), (0.5, 2, "a"), (None, 1, "n")], [(0.5, 1, "late"), (1.5, 9, "c"), (None, 0, "late")]):
        rows = spark.createDataFrame(batch, "k double, ord int, v string")
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = ingest.stream_files(spark, source, rows.schema, "parquet", 1)
    assert "Pandas" not in ingest.new_keys(stream, ["k"], ["ord"])._jdf.queryExecution().analyzed().toString()
    query = ingest.stream_first_seen(stream, target, str(tmp_path / "progress"), ["k"], ["ord"])
    query.awaitTermination()
    assert query.exception() is None
    found = ingest.read_target(spark, target, rows.schema)
    assert sorted(r["v"] for r in found.filter(F.col("batch_id") == 0).collect()) == ["a", "n"]
    assert [r["v"] for r in found.filter(F.col("batch_id") == 1).collect()] == ["c"]


def test_splits_of_an_import_do_not_grow_with_its_bytes(spark, tmp_path):
    """a larger file is cut into larger splits, a small one into as many as before."""
    from checks.flow_queries import split_bytes

    for rows, least in ((200, 1024), (100_000, 1025)):
        folder = f"{tmp_path}/{rows}"
        spark.range(rows).selectExpr("concat('line number ', id)").coalesce(1).write.text(folder)
        assert split_bytes(spark, folder) >= least
    assert split_bytes(spark, f"{tmp_path}/200") == 1024


def test_larger_inputs_come_in_more_files_and_tasks(spark, tmp_path, monkeypatch):
    """F3 to F8, F18 to F20: a part of the input, one batch of a stream, may be many files; none is written by one task."""
    from checks import flow_queries, key_queries, registry
    from checks.views import ROW_ORDER
    from fieldstar.session import list_paths

    spark.range(3000).select(*[F.col("id").alias(c) for c in ROW_ORDER]).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    parquet = lambda path: [n for n in list_paths(spark, path) if n.endswith(".parquet")]
    assert registry.pieces(rows) == 1
    path, files = flow_queries.arriving(rows, F.col("l_orderkey") % 3, 3)
    assert (files, len(parquet(path))) == (1, 3)

    monkeypatch.setattr(registry, "PIECE_BYTES", 2000)
    assert registry.pieces(rows) > 6
    path, files = flow_queries.arriving(rows.filter("l_orderkey % 3 <> 1"), F.col("l_orderkey") % 3, 3)
    assert files > 1 and len(parquet(path)) == 3 * files  # the second part has no rows, but its files
    of = spark.read.parquet(path).select((F.col("l_orderkey") % 3).alias("k"), F.input_file_name().alias("f"))
    assert {r["n"] for r in of.groupBy("k").agg(F.count_distinct("f").alias("n")).collect()} == {files}
    placed = key_queries.in_files(spark, rows, "placed")
    assert placed.select("_file").distinct().count() == 6 * registry.pieces(rows, 6) > 6
    assert spark.read.parquet(path).count() == 2000 and placed.count() == 3000


def test_a_table_that_is_well_split_is_not_shuffled_again(spark, tmp_path):
    """F9, F11 to F14, F16, F17: only what comes in too few or uneven splits is spread."""
    from checks import registry

    sizes = {"one": [4000], "even": [1000] * 4, "uneven": [3700, 100, 100, 100]}
    for name, files in sizes.items():
        for n in files:
            rows = spark.range(n).selectExpr("id l_orderkey", *[f"0 {c}" for c in ("l_linenumber", "l_partkey", "l_suppkey")])
            rows = rows.selectExpr("*", "1.5 l_extendedprice", "2 l_quantity", "date'2020-01-01' l_shipdate")
            rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/lineitem.parquet")
        july = registry.view(spark, f"{tmp_path}/{name}", "july_rows")
        assert ("Exchange" in july._jdf.queryExecution().executedPlan().toString()) == (name != "even")
        assert july.count() == 4000


def test_quoted_lines_move_their_text_once(spark):
    """both running totals work on the same blocks, so the text is shuffled for the first only, and for widths not at all."""
    from fieldstar.operators.textrepair import quoted_lines, record_widths

    lines = spark.range(3000).selectExpr("'f' file", "id line_no", "concat('\"', id, '\",\"x') text")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = quoted_lines(lines)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        text = cut._jdf.queryExecution().explainString(mode)
        moved = [part for part in text.split("\n\n") if ") Exchange" in part and "text#" in part]
        assert len(moved) == 1
        widths = record_widths(cut)._jdf.queryExecution().explainString(mode)
        assert [part for part in widths.split("\n\n") if ") Exchange" in part and "text#" in part] == []
        assert cut.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_counts_are_cut_to_listed_species_before_they_meet_events(spark):
    """events are joined with the counts that are wanted only; repeated and missing ids stay what they were."""
    from fieldstar.plans import reports

    tables = {
        "places": spark.createDataFrame([(1, "d", 0.5, 0.5), (1, "d", 1.5, 1.5), (2, "d", 2.5, 2.5)], "place_id long, dataset_id string, lng double, lat double"),
        "events": spark.createDataFrame([(10, 1, "d"), (20, 2, "d"), (None, 2, "d")], "event_id long, place_id long, dataset_id string"),
        "counts": spark.createDataFrame([(10, 7, "d", 3), (20, 8, "d", 4), (20, None, "d", 5), (20, 7, "d", 6), (None, 7, "d", 1)], "event_id long, taxon_id long, dataset_id string, count int"),
        "taxa": spark.createDataFrame([(7, "a"), (7, "a"), (8, "b"), (None, "a")], "taxon_id long, sci_name string"),
    }
    found = reports.species_list(tables, ["a"])
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(found.select("count", "lng").collect()) == [(3, 0.5), (3, 0.5), (3, 1.5), (3, 1.5), (6, 2.5), (6, 2.5)]
    sliced = reports.slice_targets({**tables, "events": tables["events"].selectExpr("*", "2000 as year", "5 as day"), "taxa": tables["taxa"].selectExpr("*", "true as target")}, 2000, (1, 9), (0.0, 9.0), (0.0, 9.0))
    assert "LeftSemi" not in sliced._jdf.queryExecution().optimizedPlan().toString()


def test_card_records_take_their_widths_from_numbers(spark):
    """the widths of card records move no line; cells are the same as with widths from the lines."""
    from fieldstar.operators import textrepair

    text = ["'1','it's", "two','end'", "'2','x','end'", "'3','y','end','more'", "'4','z','end'"]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line_no long, text string")
    numbers = textrepair.carries(lines, 3)
    cut = textrepair.card_lines(lines, 3, numbers)
    names = ["id", "body", "mark"]
    cells = textrepair.parsed_records(cut, names, "'", numbers=numbers)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = lambda df: df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(file")
        assert moved(cells) < moved(textrepair.parsed_records(cut, names, "'"))
        assert moved(cut) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, textrepair.parsed_records(textrepair.card_lines(lines, 3), names, "'").collect()))
    assert ("f", 1, "1", "it's\ntwo", "end") in set(map(tuple, cells.collect()))
    counted = {r["line_no"]: r["cuts"] for r in cut.collect()}
    assert counted == {0: 1, 1: 1, 2: 2, 3: 3, 4: 2}


def test_cards_are_dealt_before_they_are_cut(spark, tmp_path, monkeypatch):
    """card files are made without spreading the raw table first, and hold the same lines."""
    from checks import text_queries

    rows = [(i % 9, "one\ntwe 'lve\nthree") for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    lines = [r["text"] for r in text_queries.quoted_lines(spark, str(tmp_path)).collect()]
    monkeypatch.setattr(text_queries, "view", None)
    written = [r[0] for r in spark.read.text(text_queries.written_cards(spark, str(tmp_path))).collect()]
    assert sorted(written) == sorted(lines) and len(written) == 90


def test_rows_that_a_join_has_dealt_arrive_without_another_shuffle(spark, tmp_path, monkeypatch):
    """r04 F1: a part whose plan shuffles is written by the tasks of that shuffle, in its files; others are dealt as before."""
    from checks import flow_queries, registry
    from fieldstar.session import list_paths

    ids = spark.range(300).selectExpr("id", "concat('v', id) v")
    ids.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    joined = rows.hint("merge").join(rows.selectExpr("id", "v as w"), "id")
    assert registry.shuffled(joined) and not registry.shuffled(rows)
    assert not registry.shuffled(rows.join(F.broadcast(rows.selectExpr("id", "v as w")), "id"))
    monkeypatch.setattr(registry, "PIECE_BYTES", 1000)
    monkeypatch.setattr(type(rows), "repartition", lambda *_: 1 / 0)
    path, files = flow_queries.arriving(joined.filter("id <> 5"), F.col("id") % 3, 3)
    monkeypatch.undo()
    assert files > 1 and len([n for n in list_paths(spark, path) if n.endswith(".parquet")]) == 3 * files
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, joined.filter("id <> 5").collect()))
    of = back.select((F.col("id") % 3).alias("k"), F.input_file_name().alias("f")).distinct()
    assert of.count() == of.select("f").distinct().count()  # no file has rows of two parts


def test_levels_of_a_batch_are_written_without_other_columns(spark, tmp_path, monkeypatch):
    """r04 F1: what a batch writes down of its places and events are their own columns, keys and order."""
    from test_incremental import observed, taxonomy
    from test_plans import ORDER

    from fieldstar.streaming import star as star_module

    written = {}
    stage = star_module.stage
    monkeypatch.setattr(star_module, "stage", lambda df, name: (written.update({name: set(df.columns)}), stage(df, name))[1])
    star = star_module.StreamedStar(spark, f"{tmp_path}/star")
    taxa = taxonomy(spark).filter("target").select("sci_name", "taxon_id")
    for batch in range(2):
        star.add(observed(spark, 6 * batch, 12), batch, taxa, ORDER, star_module.FIRST, "ebird")
    assert {"lng", "lat", "place_json", "_id"} <= written["batch-places"]
    assert {"SAMPLING_EVENT_IDENTIFIER", "lng", "lat", "event_json", "_id"} <= written["batch-events"]
    assert not {"SCIENTIFIC_NAME", "GLOBAL_UNIQUE_IDENTIFIER", "count"} & (written["batch-places"] | written["batch-events"])
    events = star.load("events").collect()
    assert sorted(r["event_id"] for r in events) == [1, 2, 3, 4, 5, 6]
    assert all("SAMPLING_EVENT_IDENTIFIER" in r["event_json"] and r["place_id"] for r in events)


def test_faults_of_width_move_no_other_text(spark, tmp_path):
    """r04 F2: lines are numbered where they are, and only lines that a fault begins with meet the faults; the rows are the same."""
    from fieldstar.operators import textrepair
    from fieldstar.sources.text import read_lines

    # Records of 2, 3 and 4 fields whose cells span lines; the last quote never closes.
    ends = ["", ',"1"', ',"1","2"']
    text = "".join(f'"{i}","a, b\nsecond ""line"" of {i}"{ends[i % 3]}\n' for i in range(2000)) + '"open\n' + "rest,\n" * 30
    (tmp_path / "cards.txt").write_text(text)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    moved = lambda df: [p for p in df._jdf.queryExecution().explainString(mode).split("\n\n") if ") Exchange" in p and "text#" in p]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = read_lines(spark, str(tmp_path / "cards.txt"), "UTF-8")
        assert moved(lines) == []
        cut = textrepair.quoted_lines(lines)
        known = textrepair.width_faults(lines, 3, cut)
        assert len(moved(known)) == 2  # all lines to the blocks that are asked for, and what is found there to the faults
        found = sorted(map(tuple, known.select("record", "first_line", "fields", "text").collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert moved(textrepair.width_faults(lines, 3, cut)) == []  # few faults: no text is moved at all
        assert sorted(map(tuple, textrepair.width_faults(cut, 3).select("record", "first_line", "fields", "text").collect())) == found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    expected = [(i + 1, 2 * i, 2 + i % 3, f'"{i}","a, b') for i in range(2000) if i % 3 != 1]
    assert found == expected + [(2001, 4000, 1, '"open')]


def test_faults_of_repeated_and_missing_line_numbers(spark):
    """r04 F2: every fault meets every line of its first number, as many times as these come; missing ones meet none."""
    from fieldstar.operators import textrepair

    rows = [("f", 0, "a", 1, 1), ("f", 0, "b", 2, 5), ("f", 1, "c", 3, 2), ("f", None, "d", 4, 7), (None, 3, "e", 5, 7), ("g", 0, "z", 1, 2)]
    lines = spark.createDataFrame(rows, "file string, line_no long, text string, record long, cuts long")
    found = textrepair.width_faults(lines, 3)
    assert found.columns == ["file", "first_line", "record", "fields", "text"]
    assert sorted(map(tuple, found.collect())) == [("f", 0, r, n, t) for r, n in ((1, 2), (2, 6)) for t in "ab"]
