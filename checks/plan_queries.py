"""Whole dataset plans over tables shaped like their raw sources.

Every raw frame carries its row order as one struct column, `ord`.
"""

from pyspark.sql import functions as F

from checks.registry import VIEWS, query, table, view
from fieldstar.functions.jsonblob import json_get
from fieldstar.plans.arthropods import arthropods
from fieldstar.plans.band_records import band_records
from fieldstar.plans.banding_stations import banding_stations
from fieldstar.plans.july_counts import july_counts
from fieldstar.plans.nest_attempts import nest_attempts
from fieldstar.plans.survey_routes import survey_routes
from fieldstar.plans.taxonomy import base_taxonomy
from fieldstar.plans.transects import transects
from fieldstar.schema import SCHEMAS, conform

ORDER = ["ord"]
LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def ordered(df, *cols):
    return df.withColumn("ord", F.struct(*cols)).drop(*[c for c in cols if c.startswith("l_")])


def no_rows(spark, **known):
    """Empty target tables but for the given frames."""
    empty = {t: spark.createDataFrame([], schema) for t, schema in SCHEMAS.items()}
    return {**empty, **{t: conform(df, t) for t, df in known.items()}}


# Base taxonomy: names repeat, some are known already.
VIEWS["known_names"] = """
select min(p_partkey) as taxon_id, concat(p_name, ' ', cast(p_partkey % 50 as string)) as sci_name
from {part} where p_size = 50 group by concat(p_name, ' ', cast(p_partkey % 50 as string))
"""


@query(
    "base_taxonomy",
    """select (select max(taxon_id) from {known_names}) + row_number() over (order by p_partkey) as taxon_id, sci_name,
      split_part(sci_name, ' ', 1) as genus, 'aves' as class, p_brand as common_name, p_type as "group",
      case when sci_name in (select sci_name from {target_names}) then true end as target,
      cast(json_merge_patch('{{}}', json_object('eBird_species_code_2018', 'c' || cast(p_partkey as varchar),
        'range', nullif(range_text, ''))) as varchar) as taxon_json
    from (select *, concat(p_name, ' ', cast(p_partkey % 50 as varchar)) as sci_name,
        case when p_size % 2 = 0 then '' else 'R' || cast(p_size as varchar) end as range_text,
        row_number() over (partition by concat(p_name, ' ', cast(p_partkey % 50 as varchar)) order by p_partkey) as n
      from {part}) where n = 1 and sci_name not in (select sci_name from {known_names})""",
)
def base_taxonomy_query(spark, sf_dir):
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    taxonomy = part.select(
        F.concat(F.lit(" "), "p_name", F.lit("\t "), (key % 50).cast("string")).alias("scientific name"),
        F.col("p_brand").alias("English name"),
        F.col("p_type").alias("eBird species group"),
        F.concat(F.lit("c"), key.cast("string")).alias("eBird species code 2018"),
        F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit("R"), "p_size")).alias("range"),
        key,
    )
    raw = {"taxonomy": ordered(taxonomy, "p_partkey"), "targets": view(spark, sf_dir, "target_names")}
    tables = no_rows(spark, taxa=view(spark, sf_dir, "known_names"))
    taxa = base_taxonomy(spark, raw, tables, ORDER)["taxa"]
    return taxa.select("taxon_id", "sci_name", "genus", "class", "common_name", "group", "target", "taxon_json")


# Survey routes: customers are routes, orders are runs, lines are counts.
VIEWS["route_runs"] = """
select o_orderkey as rpid, c_nationkey as countrynum, c_custkey % 60 as statenum, c_custkey as route,
  year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day,
  case when o_orderkey % 10 = 0 then null else o_orderkey % 2500 end as starttime, o_orderkey % 1400 as endtime
from {orders} join {customer} on o_custkey = c_custkey where o_orderstatus <> 'P'
"""
VIEWS["route_counts"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, c_nationkey as countrynum,
  c_custkey % 60 as statenum, c_custkey as route, l_orderkey as rpid, year(o_orderdate) as year, l_partkey as aou,
  case when l_linenumber = 7 then null else l_quantity end as speciestotal
from {lineitem} join {orders} on l_orderkey = o_orderkey join {customer} on o_custkey = c_custkey
"""


def survey(spark, sf_dir):
    words = F.split("p_name", " ")
    species = table(spark, sf_dir, "part").select(
        words[0].alias("genus"),
        F.concat(words[1], F.lit("  / "), "p_type").alias("species"),
        F.col("p_brand").alias("english_common_name"),
        F.col("p_partkey").alias("aou"),
        F.lit("x").alias("sporder"),
        F.struct("p_partkey").alias("ord"),
    )
    key = F.col("c_custkey")
    routes = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("countrynum"),
        (key % 60).alias("statenum"),
        key.alias("route"),
        F.col("c_name").alias("routename"),
        (key % 90 - 100).alias("longitude"),
        (key % 40 + 20).alias("latitude"),
        F.struct("c_custkey").alias("ord"),
    )
    runs = view(spark, sf_dir, "route_runs")
    counts = view(spark, sf_dir, "route_counts")
    raw = {
        "species": species,
        "routes": routes,
        "weather": runs.withColumn("ord", F.struct("rpid")),
        "counts": ordered(counts, *LINE_ORDER.split(", ")),
    }
    return survey_routes(spark, raw, no_rows(spark), ORDER)


CLOCK = "case when {n} is null then '' when {n} // 100 < 24 and {n} % 100 < 60 then " + (
    "lpad(cast({n} // 100 as varchar), 2, '0') || ':' || lpad(cast({n} % 100 as varchar), 2, '0') end"
)


@query(
    "survey_route_events",
    f"""select row_number() over (order by rpid) as event_id, p.place_id, cast(year as int) as year,
      cast(dayofyear(make_date(year, month, day)) as int) as day, {CLOCK.format(n="starttime")} as started,
      {CLOCK.format(n="endtime")} as ended
    from {{route_runs}} left join (select c_custkey, row_number() over (order by c_custkey) as place_id from {{customer}}) p
      on c_custkey = route""",
)
def survey_route_events(spark, sf_dir):
    return survey(spark, sf_dir)["events"].select("event_id", "place_id", "year", "day", "started", "ended")


@query(
    "survey_route_counts",
    f"""select count_id, event_id, taxon_id, count from (
      select rpid, aou, cast(coalesce(speciestotal, 0) as int) as count,
        row_number() over (order by {LINE_ORDER}) as count_id from {{route_counts}}) c
    join (select rpid, row_number() over (order by rpid) as event_id from {{route_runs}}) using (rpid)
    join (select p_partkey as aou, taxon_id from {{part}} join (
      select p_name, p_type, row_number() over (order by min(p_partkey)) as taxon_id from {{part}} group by 1, 2)
      using (p_name, p_type)) using (aou)""",
)
def survey_route_counts(spark, sf_dir):
    return survey(spark, sf_dir)["counts"].select("count_id", "event_id", "taxon_id", "count")


# Banding stations.
VIEWS["band_species"] = """
select cast(p_partkey % 20 as string) as SPEC, concat('Genus', cast(p_partkey % 20 as string), '  sp ') as SCINAME,
  min(p_brand) as COMMONNAME from {part} group by p_partkey % 20
"""
VIEWS["full_stations"] = """
select concat('ST', lpad(cast(s_suppkey as string), 4, '0')) as STA, s_name as NAME,
  case when s_suppkey % 13 = 0 then 'bad' else cast(s_nationkey - 90 as string) end as DECLNG,
  cast(s_nationkey + 20 as string) as DECLAT,
  case s_suppkey % 4 when 0 then '01S' when 1 then 'BLK' when 2 then '05S' else 'other' end as PRECISION, s_suppkey
from {supplier}
"""


def banded(spark, sf_dir):
    names = view(spark, sf_dir, "band_species").select("*", F.struct("SPEC").alias("ord"))
    status = view(spark, sf_dir, "status")
    raw = {
        "species": names,
        "stations": view(spark, sf_dir, "full_stations").withColumn("ord", F.struct("s_suppkey")),
        "effort": view(spark, sf_dir, "effort"),
        "status": status.withColumn("ord", F.struct("YS")),
        "bands": ordered(view(spark, sf_dir, "bands"), *LINE_ORDER.split(", ")),
    }
    return banding_stations(spark, raw, no_rows(spark), ORDER)


STATION_ROWS = """
select row_number() over (order by s_suppkey) as place_id, * from {full_stations}
"""
STATION_EVENTS = f"""
select row_number() over (order by "STA", "NET", "DATE") as event_id, * from (
  select distinct b."STA", coalesce(b."NET", '?') as "NET", b."DATE", s.place_id
  from {{bands}} b join ({STATION_ROWS}) s on b."STA" = s."STA" where s."DECLNG" <> 'bad')
"""


@query(
    "banding_station_places",
    f"""select place_id, cast("DECLNG" as double) as lng, cast("DECLAT" as double) as lat,
      case "PRECISION" when '01S' then 30.92e0 when '05S' then 30.92e0 * 5 when 'BLK' then 111.32e0 * 1000 * 10
        end as radius from ({STATION_ROWS}) where "DECLNG" <> 'bad'""",
)
def banding_station_places(spark, sf_dir):
    return banded(spark, sf_dir)["places"].select("place_id", "lng", "lat", "radius")


@query(
    "banding_station_counts",
    f"""select count_id, event_id, dense_rank() over (order by "SPEC") as taxon_id, "YS" as ys from (
      select b.*, coalesce(b."NET", '?') as net_, row_number() over (order by {LINE_ORDER}) as count_id
      from {{bands}} b) b
    left join {{status}} s on substr(b."DATE", 1, 4) = s."YR" and b."STA" = s."STA" and b."SPEC" = s."SPEC"
    join ({STATION_EVENTS}) e on e."STA" = b."STA" and e."NET" = b.net_ and e."DATE" = b."DATE" """.replace(
        'dense_rank() over (order by "SPEC")', '(select count(*) from {band_species} q where q."SPEC" <= b."SPEC")'
    ),
)
def banding_station_counts(spark, sf_dir):
    counts = banded(spark, sf_dir)["counts"]
    return counts.select("count_id", "event_id", "taxon_id", json_get(F.col("count_json"), "YS").alias("ys"))


# Nest attempts: the lines of an order are the rows of one attempt.
VIEWS["nest_rows"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, o_custkey,
  cast(l_orderkey as string) as ATTEMPT_ID, concat('L', cast(o_custkey as string)) as LOC_ID,
  concat('c', cast(o_custkey as string)) as SPECIES_CODE,
  case when o_orderkey % 23 = 0 then 'x' else cast(o_custkey % 90 - 100 as string) end as LONGITUDE,
  cast(o_custkey % 50 + 10 as string) as LATITUDE,
  cast(cast(l_quantity as int) as string) as CLUTCH_SIZE_HOST_ATLEAST,
  case when l_linenumber = 4 then '' else cast(cast(l_quantity as int) as string) end as YOUNG_HOST_TOTAL_ATLEAST,
  case when l_linenumber % 2 = 0 then '' else l_returnflag end as HABITAT_CODE_1
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""


def nested(spark, sf_dir):
    rows = view(spark, sf_dir, "nest_rows")
    n = F.col("l_linenumber")
    text = F.concat(F.upper(F.date_format("l_shipdate", "ddMMMyyyy")), F.lit(":00:00:00"))
    dates = {"FIRST_LAY_DT": n <= 2, "HATCH_DT": (n == 3) | (n == 4), "FLEDGE_DT": n >= 5}
    rows = rows.withColumns({c: F.when(when, text).otherwise("") for c, when in dates.items()})
    code = F.to_json(F.struct(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("eBird_species_code_2018")))
    taxa = table(spark, sf_dir, "part").filter("p_size <= 40").select(
        F.col("p_partkey").alias("taxon_id"),
        F.col("p_name").alias("sci_name"),
        F.lit("aves").alias("class"),
        code.alias("taxon_json"),
    )
    raw = {"attempts": ordered(rows, *LINE_ORDER.split(", "))}
    return nest_attempts(spark, raw, no_rows(spark, taxa=taxa), 1999, ORDER)


NEST_USED = """
select * from {nest_rows} where "LONGITUDE" <> 'x' and o_custkey in (select p_partkey from {part} where p_size <= 40)
"""
NEST_SITES = f"""
select "LOC_ID", row_number() over (order by first_row) as place_id from (
  select "LOC_ID", min(row({LINE_ORDER})) as first_row from ({NEST_USED}) group by 1)
"""
NEST_EVENTS = f"""
select row_number() over (order by kind, "ATTEMPT_ID") as event_id, * from (
  select "ATTEMPT_ID", case when l_linenumber <= 2 then 0 when l_linenumber <= 4 then 1 else 2 end as kind,
    first(l_shipdate order by {LINE_ORDER}) as seen from ({NEST_USED}) group by 1, 2)
"""
NEST_ATTEMPTS = f"""
select "ATTEMPT_ID", first("LOC_ID" order by {LINE_ORDER}) as "LOC_ID", max(o_custkey) as taxon_id,
  max(cast("CLUTCH_SIZE_HOST_ATLEAST" as int)) as clutch, max(try_cast("YOUNG_HOST_TOTAL_ATLEAST" as int)) as young,
  coalesce(first("HABITAT_CODE_1" order by {LINE_ORDER}) filter (where "HABITAT_CODE_1" <> ''), '') as habitat
from ({NEST_USED}) group by 1
"""


@query(
    "nest_events",
    f"""select event_id, place_id, cast(case when year(seen) > 1999 then year(seen) - 100 else year(seen) end as int) as year,
      cast(dayofyear(seen) as int) as day, nullif(habitat, '') as habitat
    from ({NEST_EVENTS}) join ({NEST_ATTEMPTS}) using ("ATTEMPT_ID") join ({NEST_SITES}) using ("LOC_ID")""",
)
def nest_events(spark, sf_dir):
    events = nested(spark, sf_dir)["events"]
    habitat = json_get(F.col("event_json"), "HABITAT_CODE_1").alias("habitat")
    return events.select("event_id", "place_id", "year", "day", habitat)


@query(
    "nest_counts",
    f"""select row_number() over (order by measure, "ATTEMPT_ID") as count_id, event_id, taxon_id, count from (
      select 0 as measure, "ATTEMPT_ID", event_id, taxon_id, clutch as count
      from ({NEST_EVENTS}) join ({NEST_ATTEMPTS}) using ("ATTEMPT_ID") where kind = 0
      union all select 2, "ATTEMPT_ID", event_id, taxon_id, young
      from ({NEST_EVENTS}) join ({NEST_ATTEMPTS}) using ("ATTEMPT_ID") where kind = 1 and young is not null)""",
)
def nest_counts(spark, sf_dir):
    return nested(spark, sf_dir)["counts"].select("count_id", "event_id", "taxon_id", "count")


# Transects: customers are sites, orders are observations.
VIEWS["walks"] = """
select o_orderkey, concat('S', cast(o_custkey as string)) as Site, concat('R', cast(o_custkey % 3 as string)) as Route,
  concat(' Genus', cast(o_orderkey % 30 as string), '   species ') as sci_text, o_orderdate,
  case when o_orderkey % 8 = 0 then null else cast(o_orderkey % 50 as string) end as Total, o_orderkey % 24 as hour
from {orders}
"""


def walk_sources(spark, sf_dir):
    walks = view(spark, sf_dir, "walks")
    hour = F.col("hour").cast("string")
    day = F.date_format("o_orderdate", "M/d/yyyy")
    observations = walks.select(
        "Site",
        "Route",
        "Total",
        F.col("sci_text").alias("Scientific Name"),
        F.lit("plain").alias("Species"),
        F.when(F.col("o_orderkey") % 12 == 0, "soon").otherwise(F.concat(day, F.lit(" "), hour, F.lit(":05"))).alias(
            "Start time"
        ),
        F.concat(day, F.lit(" "), hour, F.lit(":45")).alias("End time"),
        F.lit("Kent").alias("County"),
        F.struct("o_orderkey").alias("ord"),
    )
    key = F.col("c_custkey")
    places = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("S"), key.cast("string")).alias("Site"),
        F.concat(F.lit("R"), (key % 3).cast("string")).alias("Route"),
        F.when(key % 17 == 0, "?").otherwise((key % 90 - 100).cast("string")).alias("long"),
        (key % 50 + 10).cast("string").alias("lat"),
        F.col("c_name").alias("Land Owner"),
        F.struct("c_custkey").alias("ord"),
    )
    return {"places": places, "observations": observations}


def walked(spark, sf_dir):
    return transects(spark, walk_sources(spark, sf_dir), no_rows(spark), ORDER)


WALKED = """
select *, row_number() over (order by o_orderkey) as event_id, cast(substr("Site", 2) as bigint) as custkey
from {walks} where o_orderkey % 12 <> 0
"""
WALK_PLACES = "select c_custkey, row_number() over (order by c_custkey) as place_id from {customer}"


@query(
    "transect_events",
    f"""select event_id, place_id, cast(year(o_orderdate) as int) as year, cast(dayofyear(o_orderdate) as int) as day,
      lpad(cast(hour as varchar), 2, '0') || ':05' as started, lpad(cast(hour as varchar), 2, '0') || ':45' as ended
    from ({WALKED}) join ({WALK_PLACES}) on c_custkey = custkey where custkey % 17 <> 0""",
)
def transect_events(spark, sf_dir):
    return walked(spark, sf_dir)["events"].select("event_id", "place_id", "year", "day", "started", "ended")


@query(
    "transect_counts",
    f"""select event_id as count_id, event_id, taxon_id, cast(coalesce("Total", '0') as int) as count
    from ({WALKED}) join (select sci_text, row_number() over (order by min(o_orderkey)) as taxon_id
      from ({WALKED}) group by 1) using (sci_text) where custkey % 17 <> 0""",
)
def transect_counts(spark, sf_dir):
    return walked(spark, sf_dir)["counts"].select("count_id", "event_id", "taxon_id", "count")


# July counts: one row per line, places from suppliers.
VIEWS["july_rows"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  case when l_suppkey % 19 = 0 then 'west' else cast(l_suppkey % 60 - 110 as string) end as LONGITUDE,
  cast(l_suppkey % 30 + 20 as string) as LATITUDE, concat(cast(year(l_shipdate) as string), '.0') as iYear,
  cast(month(l_shipdate) as string) as Month, cast(day(l_shipdate) as string) as Day, l_shipdate,
  case when l_linenumber = 5 then null else cast(l_quantity as string) end as SumOfBFLY_COUNT,
  concat('Gen', cast(l_partkey % 40 as string)) as Gen_Tribe_Fam, 'sp' as Species,
  case when l_partkey % 6 = 0 then null else 'code' end as SPECIES_CODE
from {lineitem}
"""


def counted_in_july(spark, sf_dir):
    rows = ordered(view(spark, sf_dir, "july_rows"), *LINE_ORDER.split(", "))
    raw = rows.withColumnsRenamed({"Gen_Tribe_Fam": "Gen/Tribe/Fam", "iYear": " iYear"})
    return july_counts(spark, {"observations": raw.drop("l_shipdate")}, no_rows(spark), ORDER)


JULY_USED = "select * from {july_rows} where \"LONGITUDE\" <> 'west'"
JULY_PLACES = f"""
select "LONGITUDE", "LATITUDE", row_number() over (order by min(row({LINE_ORDER}))) as place_id
from ({JULY_USED}) group by 1, 2
"""
JULY_EVENTS = f"""
select "LONGITUDE", "LATITUDE", l_shipdate, row_number() over (order by min(row({LINE_ORDER}))) as event_id
from ({JULY_USED}) group by 1, 2, 3
"""


@query(
    "july_events",
    f"""select event_id, place_id, cast(year(l_shipdate) as int) as year, cast(dayofyear(l_shipdate) as int) as day
    from ({JULY_EVENTS}) join ({JULY_PLACES}) using ("LONGITUDE", "LATITUDE")""",
)
def july_events(spark, sf_dir):
    return counted_in_july(spark, sf_dir)["events"].select("event_id", "place_id", "year", "day")


@query(
    "july_counts",
    f"""select count_id, event_id, taxon_id, cast(coalesce(cast("SumOfBFLY_COUNT" as double), 0) as int) as count
    from (select *, row_number() over (order by {LINE_ORDER}) as count_id from ({JULY_USED}))
    join ({JULY_EVENTS}) using ("LONGITUDE", "LATITUDE", l_shipdate)
    join (select "Gen_Tribe_Fam", row_number() over (order by min(row({LINE_ORDER}))) as taxon_id
      from ({JULY_USED}) where "SPECIES_CODE" is not null group by 1) using ("Gen_Tribe_Fam")""",
)
def july_counts_query(spark, sf_dir):
    return counted_in_july(spark, sf_dir)["counts"].select("count_id", "event_id", "taxon_id", "count")


# Arthropods: suppliers are sites, customers plants, orders surveys, lines records.
def surveyed(spark, sf_dir):
    supplier, customer, orders, lineitem = (
        table(spark, sf_dir, t) for t in ("supplier", "customer", "orders", "lineitem")
    )
    sites = supplier.select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("Name"),
        (F.col("s_suppkey") % 60 - 110).alias("Longitude"),
        (F.col("s_suppkey") % 30 + 20).alias("Latitude"),
        F.struct("s_suppkey").alias("ord"),
    )
    plants = customer.select(
        F.col("c_custkey").alias("ID"),
        (F.col("c_custkey") % 100).alias("SiteFK"),
        F.col("c_name").alias("Code"),
        F.struct("c_custkey").alias("ord"),
    )
    surveys = orders.select(
        F.col("o_orderkey").alias("ID"),
        F.col("o_custkey").alias("PlantFK"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("LocalDate"),
        F.lit("09:41:00").alias("LocalTime"),
        F.struct("o_orderkey").alias("ord"),
    )
    records = lineitem.select(
        F.col("l_partkey").alias("ID"),
        F.col("l_orderkey").alias("SurveyFK"),
        F.when(F.col("l_linenumber") == 6, None).otherwise(F.concat(F.lit("g"), F.col("l_suppkey") % 12)).alias("Group"),
        F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("Quantity"),
        F.struct(*LINE_ORDER.split(", ")).alias("ord"),
    )
    raw = {"sites": sites, "plants": plants, "surveys": surveys, "records": records}
    return arthropods(spark, raw, no_rows(spark), ORDER)


@query(
    "arthropod_events",
    """select row_number() over (order by o_orderkey) as event_id, place_id, cast(year(o_orderdate) as int) as year,
      cast(dayofyear(o_orderdate) as int) as day, '09:41' as started
    from {orders} join {customer} on c_custkey = o_custkey
    left join (select s_suppkey, row_number() over (order by s_suppkey) as place_id from {supplier})
      on s_suppkey = c_custkey % 100""",
)
def arthropod_events(spark, sf_dir):
    return surveyed(spark, sf_dir)["events"].select("event_id", "place_id", "year", "day", "started")


@query(
    "arthropod_counts",
    f"""select count_id, event_id, taxon_id, cast(l_quantity as int) as count from (
      select *, l_suppkey % 12 as g, row_number() over (order by {LINE_ORDER}) as count_id from {{lineitem}})
    join (select o_orderkey, row_number() over (order by o_orderkey) as event_id from {{orders}}
      join {{customer}} on c_custkey = o_custkey) on o_orderkey = l_orderkey
    join (select l_suppkey % 12 as g, row_number() over (order by min(row({LINE_ORDER}))) as taxon_id
      from {{lineitem}} where l_linenumber <> 6 group by 1) using (g)
    where l_linenumber not in (2, 6)""",
)
def arthropod_counts(spark, sf_dir):
    return surveyed(spark, sf_dir)["counts"].select("count_id", "event_id", "taxon_id", "count")


# Band records: the return flag tells bandings, encounters and recaptures apart.
VIEWS["band_rows"] = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_shipdate,
  cast(l_orderkey as string) as BAND_NUM, case when l_partkey >= 1000 then cast(l_partkey as string) else lpad(cast(l_partkey as string), 4, '0') end as species,
  case l_suppkey % 5 when 0 then '0' when 1 then '1' when 2 then '12' when 3 then '60' else '10' end as coarse,
  case when l_suppkey % 31 = 0 then '' else cast(l_suppkey % 90 - 120 as string) end as lng_text,
  cast(l_suppkey % 60 + 10 as string) as lat_text
from {lineitem}
"""


def banding(spark, sf_dir):
    rows = view(spark, sf_dir, "band_rows").withColumn("ord", F.struct(*LINE_ORDER.split(", ")))
    first = {"A": "banding", "N": "encounter", "R": "recapture"}
    names = {
        "banding": ("LON_DECIMAL_DEGREES", "LAT_DECIMAL_DEGREES", "BANDING_DATE", "SPECIES_ID", "COORD_PRECISION"),
        "encounter": (
            "E_LON_DECIMAL_DEGREES",
            "E_LAT_DECIMAL_DEGREES",
            "ENCOUNTER_DATE",
            "B_SPECIES_ID",
            "E_COORD_PRECISION",
        ),
    }
    names["recapture"] = names["encounter"]
    day = F.when(F.col("l_linenumber") == 7, "00/00/1990").otherwise(F.date_format("l_shipdate", "M/d/yyyy"))
    raw = {}
    for flag, kind in first.items():
        lng, lat, date, species, coarse = names[kind]
        raw[kind] = rows.filter(F.col("l_returnflag") == flag).select(
            "ord",
            "BAND_NUM",
            F.col("lng_text").alias(lng),
            F.col("lat_text").alias(lat),
            day.alias(date),
            F.col("species").alias(species),
            F.col("coarse").alias(coarse),
        )
    part = table(spark, sf_dir, "part")
    name = F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("sci_name")
    raw["codes"] = part.select(name, F.col("p_partkey").alias("species_id"))
    taxa = part.filter("p_size <= 40").select(F.col("p_partkey").alias("taxon_id"), name, F.lit("aves").alias("class"))
    return band_records(spark, raw, no_rows(spark, taxa=taxa), ORDER)


BAND_USED = f"""
select *, row_number() over (order by l_returnflag, {LINE_ORDER}) as event_id,
  case coarse when '0' then 0e0 when '1' then 111320e0 when '60' then 111320e0 else 1113200e0 end as radius,
  cast(lng_text as double) as lng, cast(lat_text as double) as lat, cast(species as bigint) as taxon_id
from {{band_rows}} where coarse <> '12' and lng_text <> '' and l_linenumber <> 7
  and cast(species as bigint) in (select p_partkey from {{part}} where p_size <= 40)
"""
BAND_PLACES = f"""
select lng, lat, radius, row_number() over (order by min(event_id)) as place_id from ({BAND_USED}) group by 1, 2, 3
"""


@query("band_record_places", f"select * from ({BAND_PLACES})")
def band_record_places(spark, sf_dir):
    return banding(spark, sf_dir)["places"].select("place_id", "lng", "lat", "radius")


@query(
    "banding_union",
    f"""select event_id, place_id, event_id as count_id, taxon_id, cast(year(l_shipdate) as int) as year,
      cast(dayofyear(l_shipdate) as int) as day, case l_returnflag when 'A' then 'banding' when 'N' then 'encounter'
        else 'recapture' end as type
    from ({BAND_USED}) join ({BAND_PLACES}) using (lng, lat, radius)""",
)
def banding_union(spark, sf_dir):
    rows = banding(spark, sf_dir)
    kind = json_get(F.col("event_json"), "TYPE").alias("type")
    events = rows["events"].select("event_id", "place_id", "year", "day", kind)
    return events.join(rows["counts"].select("event_id", "count_id", "taxon_id"), "event_id")


@query(
    "run_all_volumes",
    """select 'ebird' as dataset_id, count(distinct (lng, lat)) as places,
      count(distinct SAMPLING_EVENT_IDENTIFIER) as events,
      count(*) filter (where SCIENTIFIC_NAME in (select sci_name from {obs_taxa} where target)) as counts, 2 as ended, 0 as again
    from {kept_obs}
    union all select 'pollard', (select count(*) from {customer} where c_custkey % 17 <> 0),
      count(*), count(*), 2, 0 from {walks} join {customer} on "Site" = 'S' || c_custkey and "Route" = 'R' || (c_custkey % 3)
    where o_orderkey % 12 <> 0 and c_custkey % 17 <> 0""",
)
def run_all_volumes(spark, sf_dir):
    """Two datasets ingested, the second after a run that was killed before it; a third run repeats none."""
    from checks.views import ROW_ORDER
    from fieldstar.plans import run_all as runs
    from fieldstar.plans.reports import dataset_volumes
    from fieldstar.session import staging_path
    from fieldstar.sinks.tables import Warehouse

    warehouse = Warehouse(spark, staging_path(spark, "warehouse"))
    warehouse.append(view(spark, sf_dir, "obs_taxa"), "taxa")
    observed = view(spark, sf_dir, "raw_obs").withColumn("ord", F.struct(*ROW_ORDER))
    sources = {"pollard": walk_sources(spark, sf_dir), "ebird": {"checklists": observed}}
    run = lambda names: runs.run_all(spark, warehouse, sources, names, resume=True, order=["ord"])
    run(["pollard"])  # all that a run killed after its first dataset has done
    run(None)
    ended = {r["dataset_id"]: r["finished"] for r in warehouse.runs().collect()}
    run(None)
    again = sum(r["finished"] != ended[r["dataset_id"]] for r in warehouse.runs().collect())
    volumes = dataset_volumes(warehouse.tables())
    return volumes.select("*", F.lit(len(ended)).alias("ended"), F.lit(again).alias("again"))
