"""Blobs, names, clock times, dates, codes and geohashes."""

from pyspark.sql import functions as F

from checks.registry import query, table, view
from checks.views import ROW_ORDER
from fieldstar.functions import geo, jsonblob, numbers, text, times
from fieldstar.operators.columns import normalize_columns


@query(
    "json_pack",
    """select o_orderkey, cast(json_merge_patch('{{}}', json_object('o_orderstatus', nullif(o_orderstatus, 'P'),
      'o_orderpriority', o_orderpriority, 'o_custkey', o_custkey)) as varchar) as event_json from {orders}""",
)
def json_pack(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
    )
    fields = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderstatus", "no_such_field"]
    return jsonblob.json_blob(rows, fields, "event_json").select("o_orderkey", "event_json")


MERGED = """
select event_id, json_merge_patch(props, json_merge_patch('{{}}', json_object('type', event_type,
  'k', case when user_id % 3 = 0 then null when user_id % 3 = 1 then null else 'new' end))) as blob from {events}
"""


@query(
    "json_merge",
    f"""select event_id, json_extract_string(blob, '$.k') as k, json_extract_string(blob, '$.type') as type,
      json_type(blob, '$.k') = 'VARCHAR' as replaced, len(json_keys(blob)) as n from ({MERGED})""",
)
def json_merge(spark, sf_dir):
    k = F.when(F.col("user_id") % 3 == 1, F.lit("")).when(F.col("user_id") % 3 == 2, F.lit("new"))
    rows = table(spark, sf_dir, "events").withColumn("other", k)
    merged = jsonblob.json_merge(rows, "props", {"type": "event_type", "k": "other"}, "blob")
    return merged.select(
        "event_id",
        jsonblob.json_get(F.col("blob"), "k").alias("k"),
        jsonblob.json_get(F.col("blob"), "type").alias("type"),
        F.col("blob").rlike('"k":"').alias("replaced"),
        F.size(F.json_object_keys("blob")).cast("long").alias("n"),
    )


@query(
    "json_expand",
    """select event_id, cast(json_extract(props, '$.k') as int) as prop_k, cast(null as varchar) as prop_none
    from {events}""",
)
def json_expand(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    return jsonblob.json_expand(rows, "props", "k int, none string", "prop_").drop("props")


@query(
    "json_presence",
    """select event_id, json_extract_string(props, '$.k') is not null as has_k,
      json_extract_string(props, '$.j') is not null as has_j from {events}""",
)
def json_presence(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        jsonblob.json_has(F.col("props"), "k").alias("has_k"),
        jsonblob.json_has(F.col("props"), "j").alias("has_j"),
    )


@query(
    "norm_names",
    """select p_partkey, p_name || '/' || p_type as sci_name, split_part(p_name, ' ', 1) as genus,
      'Brand = ' || p_brand as tagged, substr(p_name, 1, 5) as head, split_part(p_brand, '#', 1) as front
    from {part}""",
)
def norm_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    spaced = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" \t ")), F.lit("  / "), "p_type", F.lit(" "))
    name = text.tight_slash(text.squeeze_ws(spaced))
    return part.select(
        "p_partkey",
        name.alias("sci_name"),
        text.genus_of(spaced).alias("genus"),
        text.tagged_key("Brand", F.col("p_brand")).alias("tagged"),
        text.prefix(F.col("p_name"), 5).alias("head"),
        text.before(F.col("p_brand"), "#").alias("front"),
    )


@query(
    "normalized_columns",
    'select o_orderkey as "order_key", o_custkey as "cust_key_x", o_orderstatus as "s_t" from {orders}',
)
def normalized_columns(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" order key"),
        F.col("o_custkey").alias("cust-key  x"),
        F.col("o_orderstatus").alias("s/t?"),
    )
    return normalize_columns(raw)


@query(
    "time_fields",
    """select o_orderkey, cast(year(o_orderdate) as int) as year, cast(dayofyear(o_orderdate) as int) as day,
      strftime(o_orderdate, '%Y-%m-%d') as from_parts from {orders}""",
)
def time_fields(spark, sf_dir):
    d = F.col("o_orderdate")
    made = times.date_from_parts(F.year(d), F.month(d), F.dayofmonth(d))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.year_of(d).alias("year"),
        times.day_of(d).alias("day"),
        F.date_format(made, "yyyy-MM-dd").alias("from_parts"),
    )


@query(
    "time_hmm",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
      case when n is null then '' when n // 100 < 24 and n % 100 < 60
        then lpad(cast(n // 100 as varchar), 2, '0') || ':' || lpad(cast(n % 100 as varchar), 2, '0') end as clock
    from (select *, case when l_linenumber = 3 then null else l_partkey * 7 % 3000 end as n from {lineitem})""",
)
def time_hmm(spark, sf_dir):
    n = F.when(F.col("l_linenumber") != 3, F.col("l_partkey") * 7 % 3000)
    return table(spark, sf_dir, "lineitem").select(*ROW_ORDER, times.int_hhmm(n).alias("clock"))


@query(
    "time_hhm_text",
    """select "STA", "NET", "DATE", substr(coalesce("START", '000'), 1, 2) || ':'
      || substr(coalesce("START", '000') || '00', 3, 2) as clock from {effort}""",
)
def time_hhm_text(spark, sf_dir):
    clock = times.hhm_to_hhmm(F.col("START")).alias("clock")
    return view(spark, sf_dir, "effort").select("STA", "NET", "DATE", clock)


@query(
    "time_wrap",
    """select GLOBAL_UNIQUE_IDENTIFIER, substr(TIME_OBSERVATIONS_STARTED, 1, 5) as started,
      strftime(cast('2000-01-01 ' || TIME_OBSERVATIONS_STARTED as timestamp)
        + to_minutes(cast(DURATION_MINUTES as bigint)), '%H:%M') as ended from {raw_obs}""",
)
def time_wrap(spark, sf_dir):
    begun = times.parse_fixed(F.col("TIME_OBSERVATIONS_STARTED"), times.CLOCK)
    ended = times.end_time(begun, numbers.to_num(F.col("DURATION_MINUTES")))
    return view(spark, sf_dir, "raw_obs").select(
        "GLOBAL_UNIQUE_IDENTIFIER", times.hhmm(begun).alias("started"), times.hhmm(ended).alias("ended")
    )


@query(
    "date_formats",
    """select o_orderkey, case when o_orderkey % 5 = 4 then null else strftime(o_orderdate, '%Y-%m-%d') end as parsed,
      strftime(o_orderdate, '%Y-%m-%d') as nest_date from {orders}""",
)
def date_formats(spark, sf_dir):
    d, kind = F.col("o_orderdate"), F.col("o_orderkey") % 5
    written = (
        F.when(kind == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(d, "M/d/yyyy"))
        .when(kind == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 3, F.concat(F.lit(" "), F.date_format(d, "M/d/yyyy H:mm")))
        .otherwise(F.lit("sometime in spring"))
    )
    nest = F.concat(F.upper(F.date_format(d, "ddMMMyyyy")), F.lit(":00:00:00"))
    parsed = times.parse_fixed(text.before(nest, ":"), times.NEST_DATE)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(times.parse_date(written), "yyyy-MM-dd").alias("parsed"),
        F.date_format(parsed, "yyyy-MM-dd").alias("nest_date"),
    )


@query(
    "century_fix",
    """select o_orderkey, cast(case when year(o_orderdate) > 1998 then year(o_orderdate) - 100
      else year(o_orderdate) end as int) as year from {orders}""",
)
def century_fix(spark, sf_dir):
    year = times.fix_century(F.year("o_orderdate"), 1998)
    return table(spark, sf_dir, "orders").select("o_orderkey", year.alias("year"))


@query(
    "km_to_m",
    """select GLOBAL_UNIQUE_IDENTIFIER, case when EFFORT_DISTANCE_KM is null then null
      else coalesce(try_cast(EFFORT_DISTANCE_KM as double), 0) * 1000 end as radius from {raw_obs}""",
)
def km_to_m(spark, sf_dir):
    radius = numbers.km_to_m(F.col("EFFORT_DISTANCE_KM")).alias("radius")
    return view(spark, sf_dir, "raw_obs").select("GLOBAL_UNIQUE_IDENTIFIER", radius)


@query(
    "count_x",
    """select GLOBAL_UNIQUE_IDENTIFIER, case when OBSERVATION_COUNT = 'X' then -1
      else cast(OBSERVATION_COUNT as int) end as count from {raw_obs}""",
)
def count_x(spark, sf_dir):
    count = numbers.count_or_x(F.col("OBSERVATION_COUNT")).alias("count")
    return view(spark, sf_dir, "raw_obs").select("GLOBAL_UNIQUE_IDENTIFIER", count)


@query(
    "lenient_numbers",
    """select GLOBAL_UNIQUE_IDENTIFIER, try_cast(LONGITUDE as double) as lng,
      cast(trunc(try_cast(LONGITUDE as double)) as int) as whole,
      coalesce(try_cast(EFFORT_DISTANCE_KM as double), -1) as filled from {raw_obs}""",
)
def lenient_numbers(spark, sf_dir):
    return view(spark, sf_dir, "raw_obs").select(
        "GLOBAL_UNIQUE_IDENTIFIER",
        numbers.to_real(F.col("LONGITUDE")).alias("lng"),
        numbers.to_int(F.col("LONGITUDE")).alias("whole"),
        numbers.fill(numbers.to_num(F.col("EFFORT_DISTANCE_KM")), -1.0).alias("filled"),
    )


GEOHASH = """list_reduce(list_transform(range(0, 7), lambda k: substr('0123456789bcdefghjkmnpqrstuvwxyz',
      cast(1 + list_sum(list_transform(range(0, 5), lambda j: ((case when (5 * k + j) % 2 = 0
        then x >> cast(17 - (5 * k + j) // 2 as bigint) else y >> cast(16 - (5 * k + j) // 2 as bigint) end) & 1)
          << (4 - j))) as bigint), 1)), lambda a, b: a || b)"""
CELLS = """(select place_id, lng, lat, cast(floor((lng + 180) / 360 * 262144) as bigint) as x,
      cast(floor((lat + 90) / 180 * 131072) as bigint) as y from {places})"""


@query("geohash7", f"select place_id, {GEOHASH} as geohash from {CELLS}")
def geohash7(spark, sf_dir):
    hashed = geo.geohash(F.col("lng"), F.col("lat"), 7).alias("geohash")
    return view(spark, sf_dir, "places").select("place_id", hashed)


# The eight bytes of a double, from its sign, exponent and mantissa; the logarithm is set right by one comparison each way.
def le_bytes(c):
    """SQL for a double column's bytes in little-endian hex."""
    exponent = f"(floor(log2(abs({c}))) - cast(abs({c}) < pow(2.0, floor(log2(abs({c})))) as int)"
    exponent += f" + cast(abs({c}) >= pow(2.0, floor(log2(abs({c}))) + 1) as int))"
    high = f"case when {c} < 0 then 2048 else 0 end + cast({exponent} + 1023 as int)"
    low = f"cast((abs({c}) / pow(2.0, {exponent}) - 1) * 4503599627370496 as bigint)"
    bits = f"case when {c} = 0 then repeat('0', 16) else printf('%03X%013X', {high}, {low}) end"
    return f"array_to_string(list_transform(range(0, 8), lambda i: substr({bits}, 15 - 2 * i, 2)), '')"


@query(
    "geo_points",
    f"""select place_id, {GEOHASH} as geohash, '0101000000' || {le_bytes('lng')} || {le_bytes('lat')} as geopoint
    from {CELLS}""",
)
def geo_points(spark, sf_dir):
    from fieldstar.plans.exchange import geo_enrich

    rows = geo_enrich(view(spark, sf_dir, "places"))
    return rows.select("place_id", "geohash", F.hex("geopoint").alias("geopoint"))
