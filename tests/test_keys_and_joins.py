import random

import pytest
from pyspark.sql import functions as F

from fieldstar.operators import aggregates, joins, keys
from fieldstar.operators.constraints import check_constraints
from fieldstar.operators.filters import bbox, extract_bbox, not_coded, require


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key."""
    rng = random.Random(7)
    data = [(1 if i % 3 == 0 else rng.randrange(50), i, rng.choice("ab")) for i in range(6000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k int, ord int, v string").repartition(7)


def test_first_and_last_per_key(skewed, rows):
    data = [tuple(r) for r in skewed.collect()]
    first = {k: min(o for kk, o, _ in data if kk == k) for k, _, _ in data}
    last = {k: max(o for kk, o, _ in data if kk == k) for k, _, _ in data}
    once = keys.first_per_key(skewed, ["k"], ["ord"])
    assert dict(rows(once, "k", "ord")) == first
    assert dict(rows(keys.first_per_key(skewed, ["k"], ["ord"], last=True), "k", "ord")) == last
    assert rows(keys.first_per_key(once, ["k"], ["ord"])) == rows(once)


def test_duplicate_mask_with_null_keys(spark, skewed):
    marked = keys.is_duplicate(skewed, ["k"], ["ord"])
    assert marked.filter(~F.col("is_duplicate")).count() == skewed.select("k").distinct().count()
    assert marked.count() == skewed.count()
    nulls = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k int, ord int")
    flags = dict(keys.is_duplicate(nulls, ["k"], ["ord"]).select("ord", "is_duplicate").collect())
    assert flags == {1: False, 2: True, 3: False}


def test_ids_are_contiguous_and_in_order(skewed):
    out = keys.assign_ids(skewed, "id", 101, ["k", "ord"])
    got = [tuple(r) for r in out.select("id", "k", "ord").orderBy("id").collect()]
    assert [g[0] for g in got] == list(range(101, 6101))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert [tuple(r) for r in out.select("id", "k", "ord").orderBy("id").collect()] == got


def test_ids_of_nothing(spark):
    assert keys.assign_ids(spark.createDataFrame([], "a int"), "id", 1, ["a"]).count() == 0
    assert keys.next_id(spark.createDataFrame([], "id long"), "id") == 1


def test_factorize_numbers_by_first_appearance(spark, rows):
    df = spark.createDataFrame([("c", 1), ("a", 2), ("c", 3), ("b", 4)], "k string, ord int")
    assert rows(keys.factorize(df, "k", "code", ["ord"]), "ord", "code") == [(1, 0), (2, 1), (3, 0), (4, 2)]


def test_first_seen_skips_known_keys(spark, rows):
    batch = spark.createDataFrame([(1, 1), (2, 2), (2, 3)], "k int, ord int")
    seen = spark.createDataFrame([(1,)], "k int")
    assert rows(keys.first_seen(batch, seen, ["k"], ["ord"])) == [(2, 2)]


def test_assert_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="not unique"):
        keys.assert_unique(df, ["k"])
    assert keys.assert_unique(df.distinct(), ["k"]).count() == 1


def test_lookup_replaces_column_and_keeps_every_row(spark, rows):
    df = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    dim = spark.createDataFrame([(1, "new")], "key int, v string")
    assert rows(joins.lookup(df, dim, {"k": "key"}, ["v"])) == [(1, "new"), (2, None), (None, None)]


def test_not_in_semantics(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "spec string")
    ref = spark.createDataFrame([("a",)], "spec string")
    null = spark.createDataFrame([("a",), (None,)], "spec string")
    empty = spark.createDataFrame([], "spec string")
    assert rows(joins.missing_codes(df, null, "spec")) == [("b",), (None,)]
    assert rows(joins.missing_codes(df, ref, "spec", null_aware=True)) == [("b",)]
    assert rows(joins.missing_codes(df, null, "spec", null_aware=True)) == []
    assert len(rows(joins.missing_codes(df, empty, "spec", null_aware=True))) == 3


def test_code_bridge_pads_and_never_cuts(spark, rows):
    codes = spark.createDataFrame([("a", "7"), ("b", "12345"), (None, "9")], "sci_name string, species_id string")
    taxa = spark.createDataFrame([("a", 1), ("b", 2)], "sci_name string, taxon_id long")
    assert rows(joins.code_bridge(codes, taxa), "species_id", "taxon_id") == [("0007", 1), ("12345", 2)]


def test_first_nonempty(spark, rows):
    df = spark.createDataFrame([(1, 1, ""), (1, 2, "b"), (1, 3, "c"), (2, 1, None), (2, 2, "")], "k int, o int, v string")
    found = df.groupBy("k").agg(aggregates.first_nonempty(F.col("v"), ["o"]).alias("v"))
    assert rows(found, "k", "v") == [(1, "b"), (2, "")]


def test_effort_events_equal_the_plain_join(spark, rows):
    bands = spark.createDataFrame(
        [("AAAA", "1", "2019-05-01", "S"), ("AAAA", "1", "2019-05-01", "T"), ("AAAA", None, "2019-05-02", "S"), ("ZZZZ", "1", "2019-05-01", "S")],
        "STA string, NET string, DATE string, STATION string",
    )
    effort = spark.createDataFrame(
        [("AAAA", "1", "2019-05-01", "063", "101", "12"), ("AAAA", "1", "2019-05-01", None, "122", "9")],
        "STA string, NET string, DATE string, START string, END string, LENGTH string",
    )
    stations = spark.createDataFrame([("AAAA", 5), ("ZZZZ", 6)], "STA string, place_id long")
    places = spark.createDataFrame([(5,)], "place_id long")
    out = aggregates.effort_events(bands, effort, stations, places)
    assert rows(out, "place_id", "STA", "NET", "DATE", "STATION", "started", "ended", "LENGTH") == [
        (5, "AAAA", "1", "2019-05-01", "T", "00:00", "12:20", "9"),
        (5, "AAAA", "?", "2019-05-02", "S", "00:00", "00:00", None),
    ]


def test_filters(spark, rows):
    df = spark.createDataFrame([("-95", "20"), ("bad", "30"), ("-200", "30"), ("-60", None)], "lng string, lat string")
    assert rows(bbox(df, "lng", "lat", (-50.0, -95.0), (20.0, 90.0))) == [(-95.0, 20.0)]
    codes = spark.createDataFrame([("12",), ("1",), (None,)], "c string")
    assert rows(not_coded(codes, "c", ["12", "72"])) == [("1",), (None,)]
    wide = spark.createDataFrame([(1, None, 1), (1, None, None), (None, 1, 1)], "a int, b int, c int")
    assert rows(require(wide, ["a"], ["b", "c"])) == [(1, None, 1)]


def test_extract_clauses(spark):
    df = spark.createDataFrame(
        [("u1", "2014-04-10", "1", "1"), ("u2", "someday", "1", "1"), ("u3", "2014-04-10", "0", "1"), ("u4", "2014-04-10", "1", "0"), (None, "2014-04-10", "1", "1")],
        "GLOBAL_UNIQUE_IDENTIFIER string, OBSERVATION_DATE string, APPROVED string, ALL_SPECIES_REPORTED string",
    ).withColumns({"LONGITUDE": F.lit("-70"), "LATITUDE": F.lit("40")})

    def kept(**clauses):
        out = extract_bbox(df, (-80.0, -60.0), (30.0, 50.0), **clauses)
        return sorted(r.GLOBAL_UNIQUE_IDENTIFIER for r in out.collect())

    assert kept() == ["u1"]
    assert kept(require_date=False) == ["u1", "u2"]
    assert kept(require_approved=False) == ["u1", "u3"]
    assert kept(require_complete=False) == ["u1", "u4"]


def test_constraints_report(spark, rows):
    places = spark.createDataFrame([(1, "d", 1.0, None), (1, "d", 1.0, 2.0)], "place_id long, dataset_id string, lng double, lat double")
    events = spark.createDataFrame([(1, 1, "d", 2014, 5), (2, 9, "d", 2014, 5)], "event_id long, place_id long, dataset_id string, year int, day int")
    datasets = spark.createDataFrame([("d", "t", "v")], "dataset_id string, title string, version string")
    found = check_constraints({"datasets": datasets, "places": places, "events": events})
    assert rows(found, "table_name", "rule", "column_name", "key", "n") == [
        ("events", "references places", "place_id", "9", 1),
        ("places", "not null", "lat", None, 1),
        ("places", "unique", "place_id", "1", 2),
    ]
