import datetime
import gzip
import os
import struct

import pytest
from pyspark.sql import functions as F

from fieldstar.plans.band_records import species_codes
from fieldstar.plans.card_files import card_files, check_files, repair_files, table_metadata
from fieldstar.plans.exchange import export_all, export_import
from fieldstar.schema import SCHEMAS, conform
from fieldstar.session import staging_dir
from fieldstar.sinks.files import import_tables, normalise_dialect, write_report
from fieldstar.sinks.tables import Warehouse, stage_view
from fieldstar.sources.dbf import read_dbf
from fieldstar.sources.relational import read_relational
from fieldstar.sources.text import read_lines, read_many, read_text_table, spread


def test_text_table_is_all_text_in_any_encoding(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_bytes('id,name\n1,"Pe\xf1a, ""x"""\n2,\n'.encode("latin-1"))
    df = read_text_table(spark, str(path), encoding="ISO-8859-1")
    assert dict(df.dtypes) == {"id": "string", "name": "string"}
    assert rows(df) == [("1", 'Peña, "x"'), ("2", None)]


def test_unquoted_gzip_and_row_order(spark, tmp_path):
    path = tmp_path / "t.txt.gz"
    with gzip.open(path, "wt") as f:
        f.write("id\tnote\n" + "".join(f'{i}\t"n{i}\n' for i in range(200)))
    df = spread(read_text_table(spark, str(path), sep="\t", quote="", row_order=True), 4)
    assert df.rdd.getNumPartitions() >= 4
    got = [r.id for r in df.orderBy("_file", "_block", "_row").collect()]
    assert got == [str(i) for i in range(200)]
    assert df.filter(F.col("note").startswith('"')).count() == 200


def test_read_many_tags_and_stacks(spark, tmp_path, rows):
    for kind, text in {"a": "x y,z\n1,2\n", "b": "x y\n3\n"}.items():
        (tmp_path / f"{kind}1.csv").write_text(text)
    df = read_many(spark, {"one": f"{tmp_path}/a*.csv", "two": f"{tmp_path}/b*.csv"})
    assert rows(df, "x_y", "z", "TYPE", "_family") == [("1", "2", "one", 0), ("3", None, "two", 1)]


def test_read_lines_keeps_blank_lines_and_order_over_splits(spark, tmp_path):
    lines = [("" if i % 7 == 0 else f"l{i} \xe9") for i in range(5000)]
    (tmp_path / "f.txt").write_bytes("\n".join(lines).encode("latin-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_lines(spark, str(tmp_path / "f.txt"))
        assert [(r.line_no, r.text) for r in got.orderBy("line_no").collect()] == list(enumerate(lines))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def write_dbf(path, rows):
    fields = [("SPEC", "C", 4), ("N", "N", 3), ("DATE", "D", 8)]
    with open(path, "wb") as f:
        f.write(struct.pack("<4BLHH20x", 3, 124, 1, 1, len(rows), 32 + 32 * 3 + 1, 16))
        for name, kind, width in fields:
            f.write(struct.pack("<11sc4xB15x", name.encode(), kind.encode(), width))
        f.write(b"\r")
        for mark, *cells in rows:
            f.write(mark + b"".join(c.encode("latin-1").ljust(w) for c, (_, _, w) in zip(cells, fields)))
        f.write(b"\x1a")


def test_dbf_by_record_ranges(spark, tmp_path, rows):
    data = [(b" ", f"s{i}", str(i), "20180704") for i in range(25)] + [(b"*", "gone", "1", ""), (b" ", "\xe9", "", "")]
    write_dbf(tmp_path / "x.DBF", data)
    df = read_dbf(spark, str(tmp_path / "x.DBF"), records=10)
    assert df.rdd.getNumPartitions() == 3
    got = rows(df)
    assert len(got) == 26 and ("s3", "3", "2018-07-04") in got and ("é", None, None) in got
    assert len(rows(read_dbf(spark, str(tmp_path)))) == 26


def test_relational_extract(spark, tmp_path, rows):
    spark.range(3).write.parquet(str(tmp_path / "routes"))
    assert rows(read_relational(spark, str(tmp_path), "routes")) == [(0,), (1,), (2,)]


def test_species_codes_from_markup(spark, rows):
    html = """<table><tr><th>Species Number</th><th>Scientific Name</th></tr>
    <tr class=x><td>7</td><td><i>Larus&nbsp;argentatus</i></td></tr><tr><td>8</td><td></td></tr></table>"""
    pages = spark.createDataFrame([(html,)], "html string")
    assert rows(species_codes(pages), "sci_name", "species_id") == [("Larus argentatus", "7")]
    turned = """<table><tr><td>x</td><th>Scientific Name</th><th>Note</th><th>Species Number</th></tr>
    <tr><td>1</td><td>Corvus corax</td><td>9</td><td>8</td></tr></table><table><tr><td>no header</td></tr></table>"""
    pages = spark.createDataFrame([(turned,), ("<p>nothing</p>",)], "html string")
    assert rows(species_codes(pages), "sci_name", "species_id") == [("Corvus corax", "8")]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def counts_of(spark, dataset_id, *ids):
    df = spark.createDataFrame([(i, dataset_id, i) for i in ids], "count_id long, dataset_id string, `count` int")
    return conform(df, "counts")


def test_append_replace_and_delete_by_dataset(spark, warehouse, rows):
    assert not warehouse.exists("counts") and warehouse.load("counts").count() == 0
    warehouse.append(counts_of(spark, "a", 1, 2), "counts")
    warehouse.append(counts_of(spark, "b", 3), "counts")
    warehouse.replace_dataset(counts_of(spark, "a", 9), "counts", "a")
    assert rows(warehouse.load("counts"), "count_id", "dataset_id") == [(3, "b"), (9, "a")]
    warehouse.replace_dataset(counts_of(spark, "a"), "counts", "a")
    assert rows(warehouse.load("counts"), "count_id") == [(3,)]
    # A dataset's new rows may be computed from its old ones.
    doubled = warehouse.load("counts").withColumn("count", F.col("count") * 2)
    warehouse.replace_dataset(doubled, "counts", "b")
    assert rows(warehouse.load("counts"), "count_id", "count") == [(3, 6)]
    warehouse.delete_dataset("b")
    assert warehouse.load("counts").count() == 0
    warehouse.drop("counts")
    assert not warehouse.exists("counts")


def test_registry_row_is_replaced(warehouse, rows):
    for title in ("old", "new"):
        warehouse.register_dataset({"dataset_id": "a", "title": title, "version": "1"})
    registry = warehouse.load("datasets")
    assert rows(registry, "dataset_id", "title") == [("a", "new")]
    assert isinstance(registry.first()["extracted"], datetime.datetime)


def test_update_column(spark, warehouse, rows):
    warehouse.append(spark.createDataFrame([(1, "a", "{}"), (2, "b", "{}")], "taxon_id long, sci_name string, taxon_json string"), "taxa")
    changes = spark.createDataFrame([(2, '{"x":1}')], "taxon_id long, taxon_json string")
    warehouse.update_column("taxa", changes, "taxon_id", "taxon_json")
    assert rows(warehouse.load("taxa"), "taxon_id", "taxon_json") == [(1, "{}"), (2, '{"x":1}')]


def test_partition_pruning_on_load(spark, warehouse):
    warehouse.append(counts_of(spark, "a", 1), "counts")
    plan = warehouse.load("counts").filter("dataset_id = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset_id" in plan


def test_exports_round_trip_with_nulls_quotes_and_newlines(spark, tmp_path, rows):
    places = conform(
        spark.createDataFrame(
            [(1, "a", 1.5, 2.0, None), (2, "a", -1.0, 2.0, ""), (3, "b", 0.1, 0.2, ' {"k":"v, \\" x\\ny"} \n z ')],
            "place_id long, dataset_id string, lng double, lat double, place_json string",
        ),
        "places",
    )
    back = export_import(spark, {"places": places}, str(tmp_path))["places"]
    assert rows(back, "place_id", "lng", "place_json") == rows(places, "place_id", "lng", "place_json")
    assert back.filter("geohash is not null and geopoint is not null").count() == 3
    again = export_import(spark, {"places": back}, str(tmp_path / "again"))["places"]
    assert rows(again, "geohash", F.hex("geopoint")) == rows(back, "geohash", F.hex("geopoint"))


def test_export_one_dataset(spark, tmp_path, rows):
    tables = {t: spark.createDataFrame([], s) for t, s in SCHEMAS.items()}
    tables["counts"] = counts_of(spark, "a", 1).union(counts_of(spark, "b", 2))
    written = export_all(tables, str(tmp_path), ["b", "taxa"])
    assert [os.path.basename(w) for w in written] == ["places_b.csv", "events_b.csv", "counts_b.csv", "taxa.csv"]
    assert rows(import_tables(spark, str(tmp_path), {"counts": ["counts_b.csv"]})["counts"], "count_id") == [(2,)]


def test_report_is_one_csv_with_header(spark, tmp_path, rows):
    parts = [spark.createDataFrame([(n,)], "name string") for n in ("b", 'a "q"')]
    write_report(parts, str(tmp_path / "r"))
    assert rows(read_text_table(spark, str(tmp_path / "r"))) == [('a "q"',), ("b",)]


def test_dialects_become_uniform(spark, tmp_path, rows):
    (tmp_path / "s.csv").write_bytes("a,b\n'1,\n2','it''s \xe9'\n".encode("latin-1"))
    (tmp_path / "d.csv").write_text('a,b\n"1,2",x\n')
    normalise_dialect(spark, {"s.csv": "'", "d.csv": '"'}, str(tmp_path), str(tmp_path / "out"))
    assert rows(read_text_table(spark, str(tmp_path / "out" / "s.csv"), multi_line=True)) == [("1,\n2", "it's é")]
    assert rows(read_text_table(spark, str(tmp_path / "out" / "d.csv"))) == [("1,2", "x")]


@pytest.mark.parametrize("split", ["100m", "4k"])
def test_records_do_not_depend_on_how_a_file_is_split(spark, tmp_path, split):
    cells = [(str(i), f"note {i},\nmore 'of' \"it\"\n{'x' * (i % 50)}", "end") for i in range(3000)]
    double = "".join('"{}","{}","{}"\n'.format(*[c.replace('"', '""') for c in row]) for row in [("id", "note", "end"), *cells])
    single = double.replace("'", "\0").replace('""', "\1").replace('"', "'").replace("\0", "''").replace("\1", '"')
    (tmp_path / "d.csv").write_text(double)
    (tmp_path / "s.csv").write_text(single)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        faults = normalise_dialect(spark, {"d.csv": '"', "s.csv": "'"}, str(tmp_path), str(tmp_path / "out"), "UTF-8")
        assert faults.count() == 0
        for name in ("d.csv", "s.csv"):
            found = spark.read.csv(str(tmp_path / "out" / name), header=True, multiLine=True, escape='"').collect()
            assert sorted(map(tuple, found)) == sorted(cells)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_an_open_quote_is_a_fault_and_not_a_table(spark, tmp_path):
    (tmp_path / "x.txt").write_text("'a','b','c'\n'1','x','y'\n'2','open\n" + "more\n" * 500)
    faults = check_files(spark, str(tmp_path), {"x": ("'", 3)}).collect()
    assert [(r["record"], r["first_line"], r["fields"]) for r in faults] == [(3, 2, 2)]


def test_ragged_rows_raise_or_are_kept(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_text("a,b\n1,2,3\n4\n5,NA\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_text_table(spark, str(tmp_path / "r.csv")).collect()
    kept = read_text_table(spark, str(tmp_path / "r.csv"), ragged="_malformed", na_values=["NA"])
    assert rows(kept) == [("1", "2", "1,2,3"), ("4", None, "4"), ("5", None, None)]


def test_dbf_truncation_raises_and_columns_are_those_of_all_files(spark, tmp_path, rows):
    write_dbf(tmp_path / "a.dbf", [(b" ", "s1", "1", "20180704")])
    whole = (tmp_path / "a.dbf").read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "b.dbf").write_bytes(whole[:-8])
    with pytest.raises(Exception, match="truncated"):
        read_dbf(spark, str(tmp_path / "cut" / "b.dbf")).collect()
    (tmp_path / "both").mkdir()
    (tmp_path / "both" / "a.dbf").write_bytes(whole)
    (tmp_path / "both" / "b.dbf").write_bytes(whole.replace(b"SPEC\0", b"CODE\0", 1))
    df = read_dbf(spark, str(tmp_path / "both"))
    assert df.columns == ["SPEC", "N", "DATE", "CODE"]
    assert rows(df) == [("s1", "1", "2018-07-04", None), (None, "1", "2018-07-04", "s1")]


def test_metadata_rows(spark):
    df = spark.createDataFrame([], "a int, b int")
    got = [(r.table, r.column, r.primary_key) for r in table_metadata({"t": df}).collect()]
    assert got == [("t", "", ""), ("t", "a", None), ("t", "b", None)]


def test_card_files(spark, tmp_path, rows):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.txt").write_text("'id','note','end'\n'1','it's\nfine','x'\n'2','b','y'\n'3','c'\n'4','d','z','w'\n")
    (source / "two.txt").write_text('"id","v"\n"1","a"\n')
    specs = {"one": ("'", 3), "two": ('"', 2)}
    repair_files(spark, str(source), str(tmp_path / "fixed"), specs)
    fixed = [r.text for r in read_lines(spark, str(tmp_path / "fixed" / "one.csv"), "UTF-8").orderBy("file", "line_no").collect()]
    assert fixed[1:3] == ["'1','it''s", "fine','x'"]
    assert [(t, n) for t, _, n in rows(check_files(spark, str(source), specs), "table", "record", "fields")] == [("one", 5)]
    (source / "one.txt").write_text("'id','note','end'\n'1','it's\nfine','x'\n'2','b','y'\n")
    done = card_files(spark, str(source), str(tmp_path / "done"), specs)
    assert done["faults"].count() == 0
    assert [(r.table, r.column) for r in done["metadata"].collect()] == [
        ("one", ""), ("one", "id"), ("one", "note"), ("one", "end"), ("two", ""), ("two", "id"), ("two", "v"),
    ]


def test_staging_views(spark, rows):
    stage_view(spark.range(2), "some_stage")
    assert rows(stage_view(spark.range(3), "some_stage")) == [(0,), (1,), (2,)]
    assert staging_dir(spark) == spark.conf.get("spark.checkpoint.dir")
