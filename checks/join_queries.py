"""Lookups, existence tests, bridges and grouped reductions."""

from pyspark.sql import functions as F

from checks.registry import query, table, view
from checks.views import ROW_ORDER
from fieldstar.functions.text import zfill
from fieldstar.operators import joins
from fieldstar.operators.aggregates import collapse_attempts, effort_events, first_nonempty
from fieldstar.operators.keys import first_per_key

ORDER_SQL = ", ".join(ROW_ORDER)


@query(
    "code_anti_join",
    """select s_suppkey, 'S' || cast(s_suppkey * 31 as varchar) as spec from {supplier} s
    where not exists (select 1 from {taxa} t where t.spec = 'S' || cast(s.s_suppkey * 31 as varchar))""",
)
def code_anti_join(spark, sf_dir):
    return joins.missing_codes(_codes(spark, sf_dir), view(spark, sf_dir, "taxa"), "spec")


def _codes(spark, sf_dir):
    code = F.concat(F.lit("S"), (F.col("s_suppkey") * 31).cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", code.alias("spec"))


@query(
    "code_not_in_null_aware",
    """select s_suppkey, 'S' || cast(s_suppkey * 31 as varchar) as spec from {supplier}
    where 'S' || cast(s_suppkey * 31 as varchar) not in (select spec from {taxa})""",
)
def code_not_in_null_aware(spark, sf_dir):
    return joins.missing_codes(_codes(spark, sf_dir), view(spark, sf_dir, "taxa"), "spec", null_aware=True)


@query(
    "code_not_in_no_nulls",
    """select s_suppkey, 'S' || cast(s_suppkey * 31 as varchar) as spec from {supplier}
    where 'S' || cast(s_suppkey * 31 as varchar) not in (select spec from {taxa} where spec is not null)""",
)
def code_not_in_no_nulls(spark, sf_dir):
    coded = view(spark, sf_dir, "taxa").filter("spec is not null")
    return joins.missing_codes(_codes(spark, sf_dir), coded, "spec", null_aware=True)


@query(
    "effort_events",
    """select s.place_id, b."STA", coalesce(b."NET", '?') as "NET", b."DATE", max(b."STATION") as "STATION",
      max(e."LENGTH") as "LENGTH",
      min(substr(coalesce(e."START", '000'), 1, 2) || ':' || substr(coalesce(e."START", '000') || '00', 3, 2)) as started,
      max(substr(coalesce(e."END", '000'), 1, 2) || ':' || substr(coalesce(e."END", '000') || '00', 3, 2)) as ended
    from {bands} b left join {effort} e on b."STA" = e."STA" and b."NET" = e."NET" and b."DATE" = e."DATE"
    join (select "STA", max(place_id) as place_id from {stations} where s_acctbal > 0 group by 1) s
      on b."STA" = s."STA"
    group by s.place_id, b."STA", b."NET", b."DATE" """,
)
def effort_events_query(spark, sf_dir):
    stations = view(spark, sf_dir, "stations")
    places = stations.filter("s_acctbal > 0").select("place_id")
    return effort_events(view(spark, sf_dir, "bands"), view(spark, sf_dir, "effort"), stations, places)


@query(
    "json_key_join",
    """select o_orderkey, o_orderpriority, event_id, year from {orders} join {visits}
    on o_orderstatus = json_extract_string(event_json, '$.STATUS')
      and 'O' || cast(o_orderkey as varchar) = json_extract_string(event_json, '$.ORDER')""",
)
def json_key_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("name", F.concat(F.lit("O"), F.col("o_orderkey").cast("string")))
    joined = joins.json_key_join(
        orders, view(spark, sf_dir, "visits"), "event_json", {"o_orderstatus": "STATUS", "name": "ORDER"}
    )
    return joined.select("o_orderkey", "o_orderpriority", "event_id", "year")


@query(
    "lookup_single",
    """select event_id, line, c.taxon_id, supp, price, sci_name from {tallies} c
    left join (select * from {taxa} where target) t on c.taxon_id = t.taxon_id""",
)
def lookup_single(spark, sf_dir):
    targets = view(spark, sf_dir, "taxa").filter("target")
    rows = joins.lookup(view(spark, sf_dir, "tallies"), targets, "taxon_id", ["sci_name"])
    return rows.select("event_id", "line", "taxon_id", "supp", "price", "sci_name")


@query(
    "lookup_composite",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, o.o_orderpriority as priority
    from {lineitem} left join {orders} o on l_orderkey = o_orderkey and l_linestatus = o_orderstatus""",
)
def lookup_composite(spark, sf_dir):
    on = {"l_orderkey": "o_orderkey", "l_linestatus": "o_orderstatus"}
    rows = joins.lookup(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), on, {"o_orderpriority": "priority"}
    )
    return rows.select(*ROW_ORDER, "priority")


@query(
    "lookup_coordinates",
    """select v.event_id, q.place_id from (select v.event_id, p.lng, p.lat from {visits} v join {places} p
      using (place_id)) v left join (select lng, lat, min(place_id) as place_id from {places}
      where dataset_id < '2' group by lng, lat) q on v.lng = q.lng and v.lat = q.lat""",
)
def lookup_coordinates(spark, sf_dir):
    places = view(spark, sf_dir, "places")
    visits = joins.lookup(view(spark, sf_dir, "visits"), places, "place_id", ["lng", "lat"], how="inner")
    known = first_per_key(places.filter("dataset_id < '2'"), ["lng", "lat"], ["place_id"])
    rows = joins.lookup(visits.drop("place_id"), known, ["lng", "lat"], ["place_id"], checked=True)
    return rows.select("event_id", "place_id")


@query(
    "semi_known",
    f"select {ORDER_SQL} from {{lineitem}} where l_partkey in (select taxon_id from {{taxa}} where target)",
)
def semi_known(spark, sf_dir):
    targets = view(spark, sf_dir, "taxa").filter("target")
    rows = joins.semi_known(table(spark, sf_dir, "lineitem"), targets, {"l_partkey": "taxon_id"})
    return rows.select(*ROW_ORDER)


@query(
    "anti_new",
    f"select {ORDER_SQL} from {{lineitem}} where l_partkey not in (select taxon_id from {{taxa}} where target)",
)
def anti_new(spark, sf_dir):
    targets = view(spark, sf_dir, "taxa").filter("target")
    rows = joins.anti_new(table(spark, sf_dir, "lineitem"), targets, {"l_partkey": "taxon_id"})
    return rows.select(*ROW_ORDER)


@query(
    "drop_known",
    """select sci_name, min(l_orderkey) as first_order from (
      select SCIENTIFIC_NAME as sci_name, l_orderkey from {raw_obs})
    where sci_name not in (select sci_name from {target_names}) group by 1""",
)
def drop_known(spark, sf_dir):
    names = view(spark, sf_dir, "raw_obs").withColumnRenamed("SCIENTIFIC_NAME", "sci_name")
    fresh = joins.drop_known(names.select("sci_name", *ROW_ORDER), view(spark, sf_dir, "target_names"), ROW_ORDER)
    return fresh.select("sci_name", F.col("l_orderkey").alias("first_order"))


@query(
    "flag_members",
    """select GLOBAL_UNIQUE_IDENTIFIER, SCIENTIFIC_NAME,
    SCIENTIFIC_NAME in (select sci_name from {target_names}) as is_target from {raw_obs}""",
)
def flag_members(spark, sf_dir):
    rows = view(spark, sf_dir, "raw_obs").select("GLOBAL_UNIQUE_IDENTIFIER", "SCIENTIFIC_NAME")
    return joins.flag_members(rows, view(spark, sf_dir, "target_names"), {"SCIENTIFIC_NAME": "sci_name"}, "is_target")


@query(
    "backfill_scalar",
    """select b.l_orderkey, b.l_linenumber, b.l_partkey, b.l_suppkey, b.l_extendedprice, s."YS"
    from {bands} b left join {status} s
    on substr(b."DATE", 1, 4) = s."YR" and b."STA" = s."STA" and b."SPEC" = s."SPEC" """,
)
def backfill_scalar(spark, sf_dir):
    status = view(spark, sf_dir, "status")
    # The same rows twice, later ones different: only the first may be used.
    twice = status.withColumn("seq", F.lit(1)).unionByName(
        status.withColumns({"seq": F.lit(2), "YS": F.lit("later")})
    )
    bands = view(spark, sf_dir, "bands").withColumn("year", F.substring("DATE", 1, 4))
    on = {"year": "YR", "STA": "STA", "SPEC": "SPEC"}
    return joins.backfill_scalar(bands, twice, on, {"YS": "YS"}, ["seq"]).select(*ROW_ORDER, "YS")


@query(
    "code_bridge",
    """select lpad(cast(s_suppkey as varchar), cast(greatest(4, length(cast(s_suppkey as varchar))) as int), '0') as species_id,
    taxon_id from {supplier} join {taxa} on taxon_id = s_suppkey * 2""",
)
def code_bridge(spark, sf_dir):
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    taxa = part.select((F.col("p_partkey")).alias("taxon_id"), F.concat(F.lit("T"), "p_partkey").alias("sci_name"))
    codes = supplier.select(
        F.col("s_suppkey").alias("species_id"), F.concat(F.lit("T"), F.col("s_suppkey") * 2).alias("sci_name")
    )
    return joins.code_bridge(codes, taxa)


@query(
    "suffix_merge",
    """select o_orderkey as id_survey, o_custkey as plant_fk, o_orderstatus as code_survey,
    c_custkey as id_plant, c_mktsegment as code_plant, c_nationkey as site_fk
    from {orders} join {customer} on o_custkey = c_custkey""",
)
def suffix_merge(spark, sf_dir):
    from fieldstar.plans.arthropods import surveyed_plants

    surveys = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("PlantFK"), F.col("o_orderstatus").alias("Code")
    )
    plants = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"), F.col("c_mktsegment").alias("Code"), F.col("c_nationkey").alias("SiteFK")
    )
    return surveyed_plants(surveys, plants, []).select(
        F.col("ID_survey").alias("id_survey"),
        F.col("PlantFK").alias("plant_fk"),
        F.col("Code_survey").alias("code_survey"),
        F.col("ID_plant").alias("id_plant"),
        F.col("Code_plant").alias("code_plant"),
        F.col("SiteFK").alias("site_fk"),
    )


@query(
    "suffix_merge_left",
    """select c_custkey, c_name, o_orderkey as order_first from {customer}
    left join (select o_custkey, min(o_orderkey) as o_orderkey from {orders} where o_orderstatus = 'F' group by 1)
      on c_custkey = o_custkey""",
)
def suffix_merge_left(spark, sf_dir):
    from fieldstar.operators.keys import first_per_key

    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")
    firsts = first_per_key(orders, ["o_custkey"], ["o_orderkey"])
    rows = joins.lookup(
        table(spark, sf_dir, "customer"), firsts, {"c_custkey": "o_custkey"}, {"o_orderkey": "order_first"}
    )
    return rows.select("c_custkey", "c_name", "order_first")


@query(
    "collapse_attempts",
    f"""select "ATTEMPT_ID", max(try_cast("CLUTCH_SIZE_HOST_ATLEAST" as double)) as "CLUTCH_SIZE_HOST_ATLEAST",
      max(try_cast("YOUNG_HOST_TOTAL_ATLEAST" as double)) as "YOUNG_HOST_TOTAL_ATLEAST",
      coalesce(first("LOC_ID" order by {ORDER_SQL}) filter (where "LOC_ID" <> ''), '') as "LOC_ID",
      coalesce(first("HABITAT_CODE_1" order by {ORDER_SQL}) filter (where "HABITAT_CODE_1" <> ''), '')
        as "HABITAT_CODE_1",
      coalesce(first("OUTCOME_CODE_LIST" order by {ORDER_SQL}) filter (where "OUTCOME_CODE_LIST" <> ''), '')
        as "OUTCOME_CODE_LIST"
    from {{nests}} group by "ATTEMPT_ID" """,
)
def collapse_attempts_query(spark, sf_dir):
    return collapse_attempts(
        view(spark, sf_dir, "nests"),
        "ATTEMPT_ID",
        ["CLUTCH_SIZE_HOST_ATLEAST", "YOUNG_HOST_TOTAL_ATLEAST"],
        ["LOC_ID", "HABITAT_CODE_1", "OUTCOME_CODE_LIST"],
        ROW_ORDER,
    )


@query(
    "first_nonempty",
    f"""select "LOC_ID", coalesce(first("HABITAT_CODE_1" order by {ORDER_SQL})
      filter (where "HABITAT_CODE_1" <> ''), '') as habitat from {{nests}} group by "LOC_ID" """,
)
def first_nonempty_query(spark, sf_dir):
    habitat = first_nonempty(F.col("HABITAT_CODE_1"), ROW_ORDER).alias("habitat")
    return view(spark, sf_dir, "nests").groupBy("LOC_ID").agg(habitat)


@query(
    "zero_padded_codes",
    """select s_suppkey, case when length(cast(s_suppkey * 37 as varchar)) >= 4 then cast(s_suppkey * 37 as varchar)
    else lpad(cast(s_suppkey * 37 as varchar), 4, '0') end as code from {supplier}""",
)
def zero_padded_codes(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", zfill(F.col("s_suppkey") * 37, 4).alias("code"))
