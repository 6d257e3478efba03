import json
import math
import struct

import pytest
from pyspark.sql import functions as F

from fieldstar.functions import geo, jsonblob, numbers, text, times
from fieldstar.operators.columns import normalize_columns, normalize_name


def values(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "name, clean",
    [("OBSERVATION DATE", "OBSERVATION_DATE"), (" LOCALITY TYPE", "LOCALITY_TYPE"), ("a - b", "a__b"), ("x?", "x")],
)
def test_names(name, clean):
    assert normalize_name(name) == clean


def test_normalize_columns(spark):
    assert normalize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `c/` int")).columns == ["a_b", "c"]


def test_text(spark):
    assert values(spark, text.squeeze_ws, ["  a \t b ", "x y", None, ""]) == ["a b", "x y", None, ""]
    assert values(spark, text.genus_of, ["  Larus  argentatus ", "", None]) == ["Larus", None, None]
    assert values(spark, text.tight_slash, ["a / b", "a/b", "a  /b"]) == ["a/b", "a/b", "a/b"]
    assert values(spark, lambda c: text.zfill(c, 4), ["7", "12345", None]) == ["0007", "12345", None]
    assert values(spark, lambda c: text.before(c, ":"), ["04MAY2012:00:00", "x"]) == ["04MAY2012", "x"]
    assert values(spark, text.escape_quotes, ["it's", "''"]) == ["it''s", "''''"]
    assert values(spark, lambda c: text.tagged_key("aou", c), [31], "int") == ["aou = 31"]
    joined = spark.createDataFrame([("a", "b"), ("a", None)], "a string, b string")
    assert [r[0] for r in joined.select(text.join_name(F.col("a"), F.col("b"))).collect()] == ["a b", None]


def test_numbers(spark):
    assert values(spark, numbers.to_num, [" 12 ", "1.0d", "3e2", "NaN", "x", "", None, "-.5", "5."]) == [
        12.0, None, 300.0, None, None, None, None, -0.5, 5.0,
    ]
    assert values(spark, numbers.to_int, ["3.0", "3.9", "99999999999", "x"]) == [3, 3, None, None]
    assert values(spark, numbers.km_to_m, ["1.5", "n/a", None]) == [1500.0, 0.0, None]
    assert values(spark, numbers.count_or_x, ["X", "12", "many", None]) == [-1, 12, None, None]
    table = {30.92: ("01S",), 7.0: ("a", "b")}
    assert values(spark, lambda c: numbers.radius_m(c, table), ["01S", "b", "z", None]) == [30.92, 7.0, None, None]
    assert values(spark, lambda c: numbers.radius_m(c, table, 1.0), ["z", None]) == [1.0, 1.0]


def test_dates(spark):
    def day(c):
        return F.date_format(times.parse_date(c), "yyyy-MM-dd HH:mm")

    assert values(spark, day, ["2014-04-10", "4/9/2014 7:05", "2014-13-01", "soon", None, " 2014-04-10 06:30:00 "]) == [
        "2014-04-10 00:00", "2014-04-09 07:05", None, None, None, "2014-04-10 06:30",
    ]
    iso = lambda c: F.date_format(times.parse_fixed(c, times.ISO_DATE), "yyyy-MM-dd")
    assert values(spark, iso, ["2014-04-10", "2014-4-1", "2014-02-30", "2014-04-10x"]) == ["2014-04-10", None, None, None]
    nest = lambda c: F.dayofyear(times.parse_fixed(c, times.NEST_DATE))
    assert values(spark, nest, ["10APR2014", "31FEB2014", ""]) == [100, None, None]
    parts = spark.createDataFrame([(2014, 4, 10), (2014, 2, 30), (None, 1, 1)], "y int, m int, d int")
    made = parts.select(times.date_from_parts(F.col("y"), F.col("m"), F.col("d")).cast("string"))
    assert [r[0] for r in made.collect()] == ["2014-04-10", None, None]


def test_clock_times(spark):
    assert values(spark, times.int_hhmm, ["905", "2359", "2400", "1260", "", None, "5"]) == [
        "09:05", "23:59", None, None, "", "", "00:05",
    ]
    assert values(spark, times.hhm_to_hhmm, ["063", "12", None]) == ["06:30", "12:00", "00:00"]
    ended = lambda c: times.hhmm(times.end_time(times.parse_fixed(F.lit("23:30:00"), times.CLOCK), numbers.to_num(c)))
    assert values(spark, ended, ["90", "0.5", None, "1e300"]) == ["01:00", "23:30", None, None]
    assert values(spark, lambda c: times.fix_century(c, 2020), [2021, 2020, None], "int") == [1921, 2020, None]


def test_json_blob(spark):
    df = spark.createDataFrame([("x", "", None, 3), ("é\"", "b", "c", None)], "a string, b string, c string, n int")
    blobs = [r[0] for r in jsonblob.json_blob(df, ["a", "b", "a", "n", "absent"], "j").select("j").collect()]
    assert blobs == ['{"a":"x","n":3}', '{"a":"é\\"","b":"b"}']


def test_json_merge_keeps_places_types_and_odd_blobs(spark):
    df = spark.createDataFrame(
        [('{"a":1,"b":"x","c":[1]}', "new", ""), ("{}", None, "z"), (None, "n", None), ("not json", "n", None)],
        "j string, b string, d string",
    )
    merged = [r[0] for r in jsonblob.json_merge(df, "j", ["b", "d"]).select("j").collect()]
    assert merged == ['{"a":1,"b":"new","c":[1]}', '{"d":"z"}', '{"b":"n"}', "not json"]


def test_json_expand_and_get(spark):
    df = spark.createDataFrame([('{"a b":1,"x":null}',)], "j string")
    row = df.select(jsonblob.json_get(F.col("j"), "a b"), jsonblob.json_has(F.col("j"), "x")).first()
    assert tuple(row) == ("1", False)
    assert jsonblob.json_expand(df, "j", "`a b` int").first()["a b"] == 1


def test_geohash_known_points_and_cell_edges(spark):
    points = [(-5.6, 42.6), (10.40744, 57.64911), (180.0, 90.0), (-180.0, -90.0), (0.0, 0.0), (-0.0000001, 0.0)]

    def brute(lng, lat, n=7):
        box, bits, out = [[-180.0, 180.0], [-90.0, 90.0]], [], ""
        for i in range(5 * n):
            side, value = box[i % 2], (lng, lat)[i % 2]
            mid = sum(side) / 2
            bits.append(int(value >= mid))
            side[0 if value >= mid else 1] = mid
        for i in range(0, 5 * n, 5):
            out += geo.BASE32[int("".join(map(str, bits[i : i + 5])), 2)]
        return out

    edges = [(k * 360 / 2**18 - 180, k * 180 / 2**17 - 90) for k in (1, 777, 65535, 131071)]
    near = [(x - 1e-13, y - 1e-13) for x, y in edges]
    df = spark.createDataFrame(points + edges + near, "lng double, lat double")
    found = [r[0] for r in df.select(geo.geohash(F.col("lng"), F.col("lat"))).collect()]
    assert found == [brute(*p) for p in points + edges + near]
    assert found[0].startswith("ezs42") and found[1] == "u4pruyd"


def test_wkb_point(spark):
    values = [-72.5, 40.25, 0.0, -0.0, 1.0, -1.0, 0.1, 1 / 3, 179.99999999999997, -180.0, 5e-324, 2.0**-1022, 1e308, -1e-310]
    values += [2.0**e for e in range(-30, 31)] + [math.nextafter(2.0**e, 0) for e in range(-30, 31)]
    pairs = list(zip(values, values[::-1], strict=True))
    rows = [*pairs, (None, 1.0), (1.0, None), (math.inf, 1.0), (1.0, math.nan)]
    df = spark.createDataFrame(rows, "lng double, lat double")
    made = [r[0] for r in df.select(geo.wkb_point("lng", "lat")).collect()]
    assert [bytes(m) for m in made[: len(pairs)]] == [struct.pack("<BIdd", 1, 1, *p) for p in pairs]
    assert made[len(pairs) :] == [None] * 4


def test_blob_is_json(spark):
    df = spark.createDataFrame([('quote " and \\ and\nline',)], "a string")
    assert json.loads(jsonblob.json_blob(df, ["a"], "j").first()["j"]) == {"a": 'quote " and \\ and\nline'}
