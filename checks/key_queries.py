"""First rows, duplicates, ids, constraints, reshapes and the star split."""

from pyspark.sql import functions as F

from checks.registry import pieces, query, table, view
from checks.views import ROW_ORDER
from fieldstar.functions.numbers import radius_m
from fieldstar.operators import keys
from fieldstar.operators.constraints import check_constraints, fk_violations, null_violations, unique_violations
from fieldstar.operators.joins import lookup
from fieldstar.operators.reshape import melt_counts, melt_events, number_rows
from fieldstar.plans.checklists import (
    EVENT_KEY,
    PLACE_KEY,
    count_rows,
    event_rows,
    place_rows,
    target_taxa,
    usable_checklists,
)
from fieldstar.session import stage

ORDER_SQL = ", ".join(ROW_ORDER)
LINE = ["l_orderkey", "l_linenumber"]
REST = ["l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "first_per_key",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_partkey, l_suppkey, l_extendedprice) as n from {lineitem}) where n = 1""",
)
def first_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*ROW_ORDER, "l_quantity")
    return keys.first_per_key(rows, LINE, REST)


@query(
    "dup_mask",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
      row_number() over (partition by l_orderkey, l_linenumber
        order by l_partkey, l_suppkey, l_extendedprice) > 1 as is_duplicate from {lineitem}""",
)
def dup_mask(spark, sf_dir):
    return keys.is_duplicate(table(spark, sf_dir, "lineitem").select(*ROW_ORDER), LINE, REST)


@query(
    "factorize",
    f"""select {ORDER_SQL}, code from {{lineitem}} join (
      select l_partkey as part, dense_rank() over (order by first_row) - 1 as code from (
        select l_partkey, min(row(l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) as first_row
        from {{lineitem}} group by 1)) on part = l_partkey""",
)
def factorize(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*ROW_ORDER)
    return keys.factorize(rows, "l_partkey", "code", ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"])


@query(
    "assign_ids",
    f"select {ORDER_SQL}, 1000 + row_number() over (order by {ORDER_SQL}) as count_id from {{lineitem}}",
)
def assign_ids(spark, sf_dir):
    return keys.assign_ids(table(spark, sf_dir, "lineitem").select(*ROW_ORDER), "count_id", 1001, ROW_ORDER)


@query(
    "next_id",
    f"""select {ORDER_SQL}, (select coalesce(max(o_orderkey), 0) from {{orders}})
      + row_number() over (order by {ORDER_SQL}) as event_id from {{lineitem}}""",
)
def next_id(spark, sf_dir):
    start = keys.next_id(table(spark, sf_dir, "orders"), "o_orderkey")
    return keys.assign_ids(table(spark, sf_dir, "lineitem").select(*ROW_ORDER), "event_id", start, ROW_ORDER)


@query(
    "first_seen",
    """select l_partkey, l_suppkey, min(l_orderkey) as l_orderkey from {lineitem} b where l_linestatus = 'O'
      and not exists (select 1 from {lineitem} s where s.l_linestatus = 'F' and s.l_partkey = b.l_partkey
        and s.l_suppkey = b.l_suppkey) group by 1, 2""",
)
def first_seen(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    batch, seen = rows.filter("l_linestatus = 'O'"), rows.filter("l_linestatus = 'F'")
    found = keys.first_seen(batch.select(*ROW_ORDER), seen, ["l_partkey", "l_suppkey"], ROW_ORDER)
    return found.select("l_partkey", "l_suppkey", "l_orderkey")


def faulty(spark, sf_dir):
    """The star with repeated places, orphan visits and missing counts."""
    places, visits = view(spark, sf_dir, "places"), view(spark, sf_dir, "visits")
    tallies = view(spark, sf_dir, "tallies")
    return {
        "places": places.unionByName(places.filter("place_id % 100 = 0")).withColumn(
            "lat", F.when(F.col("place_id") % 9 != 0, F.col("lat"))
        ),
        "events": visits.withColumn(
            "place_id", F.when(F.col("event_id") % 50 == 0, F.col("place_id") + 10**9).otherwise(F.col("place_id"))
        ),
        "counts": tallies.withColumn("count", F.when(F.col("count") >= 0, F.col("count"))),
    }


UNIQUE = """
select 'places' as table_name, 'unique' as rule, 'place_id' as column_name, cast(place_id as varchar) as key, 2 as n
from {places} where place_id % 100 = 0
"""
FOREIGN = """
select 'events' as table_name, 'references places' as rule, 'place_id' as column_name,
  cast(place_id + 1000000000 as varchar) as key, count(*) as n
from {visits} where event_id % 50 = 0 group by place_id
"""
NULLS = """
select 'counts' as table_name, 'not null' as rule, 'count' as column_name, cast(null as varchar) as key, count(*) as n
from {tallies} where count < 0 having count(*) > 0
"""


@query("unique_violations", UNIQUE)
def unique_violations_query(spark, sf_dir):
    return unique_violations(faulty(spark, sf_dir)["places"], "places")


@query("fk_violations", FOREIGN)
def fk_violations_query(spark, sf_dir):
    tables = faulty(spark, sf_dir)
    return fk_violations(tables["events"], "events", tables)


@query("null_violations", NULLS)
def null_violations_query(spark, sf_dir):
    return null_violations(faulty(spark, sf_dir)["counts"], "counts")


@query(
    "check_constraints",
    f"""{UNIQUE} union all {FOREIGN} union all {NULLS} union all
    select 'places', 'not null', 'lat', null, count(*) from (
      select place_id from {{places}} union all select place_id from {{places}} where place_id % 100 = 0)
    where place_id % 9 = 0""",
)
def check_constraints_query(spark, sf_dir):
    return check_constraints(faulty(spark, sf_dir))


DATES = {"laid": "lay_date", "hatched": "hatch_date", "fledged": "fledge_date"}


@query(
    "melt_events",
    """select attempt, event_type, cast(cast(d as date) as varchar) as date from (
      select attempt, 'laid' as event_type, lay_date as d from {attempts}
      union all select attempt, 'hatched', hatch_date from {attempts}
      union all select attempt, 'fledged', fledge_date from {attempts}) where d is not null""",
)
def melt_events_query(spark, sf_dir):
    rows = melt_events(view(spark, sf_dir, "attempts"), DATES, ["attempt"])
    return rows.select("attempt", "event_type", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query(
    "melt_counts",
    """select attempt, event_type, count_type, count from (
      select attempt, 'laid' as event_type, 'clutch' as count_type, clutch as count, lay_date as d from {attempts}
      union all select attempt, 'hatched', 'eggs', eggs, hatch_date from {attempts}
      union all select attempt, 'fledged', 'young', young, fledge_date from {attempts})
    where d is not null and count is not null""",
)
def melt_counts_query(spark, sf_dir):
    rows = melt_events(view(spark, sf_dir, "attempts"), DATES)
    measures = {"clutch": "laid", "eggs": "hatched", "young": "fledged"}
    return melt_counts(rows, measures, ["attempt"]).drop("count_rank")


def numbered(spark, sf_dir, *levels):
    """Wanted levels of the checklist star, each numbered from 1."""
    rows = usable_checklists(view(spark, sf_dir, "raw_obs"))
    rows = stage(rows, "checklists") if len(levels) > 1 else rows
    taxa = target_taxa(view(spark, sf_dir, "obs_taxa"))
    made = {
        "places": lambda: number_rows(rows, PLACE_KEY, "place_id", 1, ROW_ORDER, place_rows, PLACE_KEY),
        "events": lambda: number_rows(rows, EVENT_KEY, "event_id", 1, ROW_ORDER, event_rows, [*PLACE_KEY, *EVENT_KEY]),
        "counts": lambda: number_rows(rows, None, "count_id", 1, ROW_ORDER, lambda df: count_rows(df, taxa), EVENT_KEY),
    }
    return [made[level]() for level in levels]


PLACE_ROWS = f"""
select *, row_number() over (order by {ORDER_SQL}) as place_id from (
  select *, row_number() over (partition by lng, lat order by {ORDER_SQL}) as n from {{kept_obs}}) where n = 1
"""
EVENT_ROWS = f"""
select *, row_number() over (order by {ORDER_SQL}) as event_id from (
  select *, row_number() over (partition by SAMPLING_EVENT_IDENTIFIER order by {ORDER_SQL}) as n
  from {{kept_obs}}) where n = 1
"""


STAR_PLACES = f"""select place_id, lng, lat, case when EFFORT_DISTANCE_KM is null then null
      else coalesce(try_cast(EFFORT_DISTANCE_KM as double), 0) * 1000 end as radius,
      cast(json_merge_patch('{{{{}}}}', json_object('STATE_CODE', STATE_CODE, 'LOCALITY_TYPE', nullif(LOCALITY_TYPE, '')))
        as varchar) as place_json from ({PLACE_ROWS})"""


@query("star_places", STAR_PLACES)
def star_places(spark, sf_dir):
    (places,) = numbered(spark, sf_dir, "places")
    return places.select("place_id", "lng", "lat", "radius", "place_json")


STAR_EVENTS = f"""select event_id, p.place_id, cast(year(seen) as int) as year, cast(dayofyear(seen) as int) as day,
      substr(TIME_OBSERVATIONS_STARTED, 1, 5) as started,
      strftime(cast('2000-01-01 ' || TIME_OBSERVATIONS_STARTED as timestamp)
        + to_minutes(try_cast(DURATION_MINUTES as bigint)), '%H:%M') as ended,
      cast(json_merge_patch('{{{{}}}}', json_object('SAMPLING_EVENT_IDENTIFIER', SAMPLING_EVENT_IDENTIFIER,
        'APPROVED', APPROVED, 'ALL_SPECIES_REPORTED', ALL_SPECIES_REPORTED, 'OBSERVATION_DATE', OBSERVATION_DATE,
        'DURATION_MINUTES', DURATION_MINUTES)) as varchar) as event_json
    from ({EVENT_ROWS}) e join (select place_id, lng, lat from ({PLACE_ROWS})) p using (lng, lat)"""


@query("star_events", STAR_EVENTS)
def star_events(spark, sf_dir):
    places, events = numbered(spark, sf_dir, "places", "events")
    events = lookup(events, places, PLACE_KEY, ["place_id"])
    return events.select("event_id", "place_id", "year", "day", "started", "ended", "event_json")


STAR_COUNTS = f"""select count_id, event_id, taxon_id, case when OBSERVATION_COUNT = 'X' then -1
      else cast(OBSERVATION_COUNT as int) end as count,
      cast(json_object('SCIENTIFIC_NAME', SCIENTIFIC_NAME, 'GLOBAL_UNIQUE_IDENTIFIER', GLOBAL_UNIQUE_IDENTIFIER)
        as varchar) as count_json
    from (select k.*, taxon_id, row_number() over (order by {ORDER_SQL}) as count_id
      from {{kept_obs}} k join {{obs_taxa}} t on t.sci_name = k.SCIENTIFIC_NAME where target) c
    join (select event_id, SAMPLING_EVENT_IDENTIFIER from ({EVENT_ROWS})) using (SAMPLING_EVENT_IDENTIFIER)"""


@query("star_counts", STAR_COUNTS)
def star_counts(spark, sf_dir):
    events, counts = numbered(spark, sf_dir, "events", "counts")
    counts = lookup(counts, events, EVENT_KEY, ["event_id"])
    return counts.select("count_id", "event_id", "taxon_id", "count", "count_json")


@query(
    "radius_case",
    """select c_custkey, case c_mktsegment when 'AUTOMOBILE' then 30.92e0 when 'BUILDING' then 154.6e0
      when 'MACHINERY' then 1113200e0 when 'HOUSEHOLD' then 1113200e0 end as radius from {customer}""",
)
def radius_case(spark, sf_dir):
    table_ = {30.92: ("AUTOMOBILE",), 30.92 * 5: ("BUILDING",), 111.32 * 1000 * 10: ("MACHINERY", "HOUSEHOLD")}
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", radius_m(F.col("c_mktsegment"), table_).alias("radius"))


def by_arrival(sql):
    """The oracle's text with rows taken in the order in which the stream gets them."""
    return sql.replace(f"order by {ORDER_SQL}", f"order by l_orderkey % 3, {ORDER_SQL}")


def streamed_star(spark, sf_dir):
    """The checklist star grown from three files, one after the other."""
    from checks.flow_queries import arriving
    from fieldstar.session import staging_path
    from fieldstar.streaming.ingest import stream_files
    from fieldstar.streaming.star import StreamedStar, stream_checklists

    rows = view(spark, sf_dir, "raw_obs")
    path, files = arriving(rows, F.col("l_orderkey") % 3, 3)
    source = stream_files(spark, path, rows.schema, "parquet", files)
    root = staging_path(spark, "streamed-star")
    taxa = view(spark, sf_dir, "obs_taxa")
    stream_checklists(source, root, staging_path(spark, "progress"), taxa, ROW_ORDER).awaitTermination()
    return StreamedStar(spark, root)


@query("stream_checklists_places", by_arrival(STAR_PLACES))
def stream_checklists_places(spark, sf_dir):
    return streamed_star(spark, sf_dir).load("places").select("place_id", "lng", "lat", "radius", "place_json")


@query("stream_checklists_events", by_arrival(STAR_EVENTS))
def stream_checklists_events(spark, sf_dir):
    events = streamed_star(spark, sf_dir).load("events")
    return events.select("event_id", "place_id", "year", "day", "started", "ended", "event_json")


@query("stream_checklists_counts", by_arrival(STAR_COUNTS))
def stream_checklists_counts(spark, sf_dir):
    return streamed_star(spark, sf_dir).load("counts").select("count_id", "event_id", "taxon_id", "count", "count_json")


def in_files(spark, rows, name):
    """The rows written in their order, file after file, and read back in file order."""
    from fieldstar.session import staging_path
    from fieldstar.sources.text import with_row_order

    path, files = staging_path(spark, name), 6 * pieces(rows, 6)
    by = [F.col(c) for c in ROW_ORDER]
    rows.repartitionByRange(files, *by).sortWithinPartitions(*by).write.parquet(path)
    return with_row_order(spark.read.schema(rows.schema).parquet(path))


@query(
    "assign_ids_in_place",
    f"""select {ORDER_SQL}, 1000 + row_number() over (order by {ORDER_SQL}) as count_id
    from {{lineitem}} where l_linenumber <> 3""",
)
def assign_ids_in_place(spark, sf_dir):
    """Rows numbered where they stand in their files, some filtered out before."""
    rows = in_files(spark, table(spark, sf_dir, "lineitem").select(*ROW_ORDER), "in-place").filter("l_linenumber <> 3")
    return keys.assign_ids(rows, "count_id", 1001, keys.FILE_ORDER).select(*ROW_ORDER, "count_id")


@query("star_counts_in_files", STAR_COUNTS)
def star_counts_in_files(spark, sf_dir):
    """The counts of raw files, numbered in file order without being moved for it."""
    from fieldstar.plans.checklists import split_checklists

    rows = stage(usable_checklists(in_files(spark, view(spark, sf_dir, "raw_obs"), "raw")), "checklists")
    taxa = target_taxa(view(spark, sf_dir, "obs_taxa"))
    start = {"places": 1, "events": 1, "counts": 1}
    counts = split_checklists(rows, taxa, keys.FILE_ORDER, start)[2]
    return counts.select("count_id", "event_id", "taxon_id", "count", "count_json")


INCREMENT = """
select 'places' as table_name, 'unique' as rule, 'place_id' as column_name, cast(place_id as varchar) as key, 2 as n
from {places} where place_id % 100 = 0
union all
select 'events', 'unique', 'event_id', cast(event_id as varchar), 2 from {visits} where event_id % 200 = 7
union all
select 'events', 'references places', 'place_id', cast(place_id + 1000000000 as varchar), count(*)
from {visits} where event_id % 200 = 7 group by place_id
union all
select 'counts', 'not null', 'count', null, count(*) from {tallies} where event_id % 9 = 0 and count < 0 having count(*) > 0
"""


@query("check_increment", INCREMENT)
def check_increment_query(spark, sf_dir):
    """Rules on added rows: repeated keys, parents nobody has, missing counts; stored keys are known by their filters."""
    from fieldstar.operators.increments import check_increment, key_filter

    places, visits = view(spark, sf_dir, "places"), view(spark, sf_dir, "visits")
    tallies = view(spark, sf_dir, "tallies")
    late = F.col("event_id") % 9 == 0
    stored = {"places": places, "events": visits.filter(~late), "counts": tallies.filter(~late & (F.col("count") >= 0))}
    again = visits.filter("event_id % 200 = 7").withColumn("place_id", F.col("place_id") + 10**9)
    both = visits.filter(late & ~(F.col("event_id") % 200 == 7)).unionByName(again.filter(~late))
    twice = again.filter(late)
    added = {
        "places": places.filter("place_id % 100 = 0"),
        "events": both.unionByName(twice).unionByName(twice.withColumn("place_id", F.lit(None).cast("long"))),
        "counts": tallies.filter(late).withColumn("count", F.when(F.col("count") >= 0, F.col("count"))),
    }
    columns = {"places": ["place_id"], "events": ["event_id"]}
    filters = {t: {c: key_filter(stored[t], c, 100_000) for c in cs} for t, cs in columns.items()}
    return check_increment(stored, added, filters)
