"""Reports over the star and audits of the raw observations."""

from pyspark.sql import functions as F

from checks.registry import query, table, view
from fieldstar.operators.filters import bbox, not_coded, quality_gate
from fieldstar.plans import reports

LNG, LAT, YEAR, DAYS = (-95.0, -72.0), (20.0, 60.0), 1998, (100, 200)


def star(spark, sf_dir):
    names = {"places": "places", "events": "visits", "counts": "tallies", "taxa": "taxa", "datasets": "datasets"}
    return {t: view(spark, sf_dir, v) for t, v in names.items()}


STAR = """
select place_id, p.dataset_id as place_dataset_id, lng, lat, precision_code, event_id,
       v.dataset_id as event_dataset_id, year, day, event_json, taxon_id, c.dataset_id as count_dataset_id,
       c.count as count, line, supp, price, sci_name, genus, class, common_name, spec, target
from {places} p join {visits} v using (place_id) join {tallies} c using (event_id) join {taxa} t using (taxon_id)
"""
BOX = "lng between -95 and -72 and lat between 20 and 60"
SLICE = f"{STAR} where year = 1998 and day between 100 and 200 and {BOX} and target"


@query("slice_targets", SLICE)
def slice_targets(spark, sf_dir):
    return reports.slice_targets(star(spark, sf_dir), YEAR, DAYS, LNG, LAT)


@query("slice_class", f"{SLICE} and class = 'ECONOMY'")
def slice_class(spark, sf_dir):
    return reports.slice_class(star(spark, sf_dir), "ECONOMY", YEAR, DAYS, LNG, LAT)


JSON_SLICE = f"""select lng, lat, year, day, count, sci_name, json_extract_string(event_json, '$.STATUS') as status
    from ({SLICE}) where json_extract_string(event_json, '$.STATUS') is not null"""


@query("slice_json", JSON_SLICE)
def slice_json(spark, sf_dir):
    return reports.slice_json(star(spark, sf_dir), None, "STATUS", "status", YEAR, DAYS, LNG, LAT)


@query(
    "slice_json_dataset",
    f"""select lng, lat, year, day, count, sci_name, json_extract_string(event_json, '$.ORDER') as order_name
    from ({STAR}) where year = 1998 and day between 100 and 200 and target and place_dataset_id = '7'
    and json_extract_string(event_json, '$.ORDER') is not null""",
)
def slice_json_dataset(spark, sf_dir):
    world = ((-180.0, 180.0), (-90.0, 90.0))
    return reports.slice_json(star(spark, sf_dir), "7", "ORDER", "order_name", YEAR, DAYS, *world)


@query(
    "checklist_count",
    """select count(*) as n from {places} join {visits} using (place_id)
    where year >= 1997 and day between 30 and 150 and lng between -90 and -60 and lat between 25 and 50
    and json_extract_string(event_json, '$.STATUS') is not null""",
)
def checklist_count(spark, sf_dir):
    return reports.checklist_count(
        star(spark, sf_dir), None, "STATUS", 1997, (30, 150), (-90.0, -60.0), (25.0, 50.0)
    )


@query(
    "slice_top100",
    f"""select lng, lat, year, day, count, sci_name, event_json, event_id, taxon_id, line, supp, price,
    json_extract_string(event_json, '$.STATUS') as "STATUS", json_extract_string(event_json, '$.PRIORITY') as "PRIORITY"
    from ({SLICE}) order by event_id, line, taxon_id, supp, price limit 100""",
)
def slice_top100(spark, sf_dir):
    order = ["event_id", "line", "taxon_id", "supp", "price"]
    return reports.slice_top(
        star(spark, sf_dir), None, "STATUS string, PRIORITY string", YEAR, DAYS, LNG, LAT, order
    )


SPECIES = ["red widget", "blue plate", "hot rod", "old anvil", "small ring", "new gear", "cold gizmo"]


@query(
    "species_list",
    f"select * from ({STAR}) where common_name in ({', '.join(repr(s) for s in SPECIES)})",
)
def species_list(spark, sf_dir):
    tables = star(spark, sf_dir)
    # Seventeen-odd names make a report; here the vernacular ones repeat enough to fill it.
    taxa = tables["taxa"].withColumnsRenamed({"sci_name": "full_name", "common_name": "sci_name"})
    rows = reports.species_list({**tables, "taxa": taxa}, SPECIES)
    return rows.withColumnsRenamed({"sci_name": "common_name", "full_name": "sci_name"})


@query(
    "missing_names",
    """select 'parts' as dataset, concat(p_name, ' ', cast(p_partkey % 50 as string)) as sci_name,
      min(p_brand) as common_name, '' as key
    from {part} where concat(p_name, ' ', cast(p_partkey % 50 as string)) not in (select sci_name from {taxa})
    group by 2
    union all
    select 'suppliers', s_name, cast(s_nationkey as string), concat('supp = ', cast(s_suppkey as string))
    from {supplier} where s_name not in (select sci_name from {taxa})
    union all
    select 'nations', n_name, cast(null as string), concat('nation = ', cast(n_nationkey as string))
    from {nation} where n_name not in (select sci_name from {taxa})""",
)
def missing_names(spark, sf_dir):
    part, supplier, nation = (table(spark, sf_dir, t) for t in ("part", "supplier", "nation"))
    name = F.concat("p_name", F.lit(" "), (F.col("p_partkey") % 50).cast("string"))
    sources = {
        "parts": reports.named_source(part, name, F.col("p_brand"), None, None),
        "suppliers": reports.named_source(
            supplier, F.col("s_name"), F.col("s_nationkey").cast("string"), "supp", F.col("s_suppkey")
        ),
        "nations": reports.named_source(
            nation, F.col("n_name"), F.lit(None).cast("string"), "nation", F.col("n_nationkey")
        ),
    }
    order = {"parts": ["p_brand", "p_partkey"], "suppliers": ["s_suppkey"], "nations": ["n_nationkey"]}
    return reports.missing_names(sources, view(spark, sf_dir, "taxa"), order)


@query(
    "audit_species",
    """select t.sci_name, count(k.SCIENTIFIC_NAME) as n
    from {target_names} t left join {kept_obs} k on k.SCIENTIFIC_NAME = t.sci_name group by t.sci_name""",
)
def audit_species(spark, sf_dir):
    return reports.audit_species(view(spark, sf_dir, "raw_obs"), view(spark, sf_dir, "target_names"))


@query(
    "audit_totals",
    """select count(distinct (lng, lat)) as places, count(distinct SAMPLING_EVENT_IDENTIFIER) as events,
    count(*) filter (where SCIENTIFIC_NAME in (select sci_name from {target_names})) as counts from {kept_obs}""",
)
def audit_totals(spark, sf_dir):
    return reports.audit_totals(view(spark, sf_dir, "raw_obs"), view(spark, sf_dir, "target_names"))


@query(
    "audit_totals_approximate",
    """select true as places_close, true as events_close,
    count(*) filter (where SCIENTIFIC_NAME in (select sci_name from {target_names})) as counts from {kept_obs}""",
)
def audit_totals_approximate(spark, sf_dir):
    """Sketches of three batches, kept by year and merged, within four standard errors of the exact counts."""
    from fieldstar.plans.sketches import audit_sketches, merged_sketches, sketched_totals

    raw, targets = view(spark, sf_dir, "raw_obs"), view(spark, sf_dir, "target_names")
    kept = [None] * 3
    for k in range(3):
        batch = reports.audited(raw.filter(F.col("l_linenumber") % 3 == k))
        kept[k] = audit_sketches(batch, targets, F.lit("ebird"))
    merged = merged_sketches(kept[0].unionByName(kept[1]).unionByName(kept[2]))
    about = sketched_totals(merged).withColumnsRenamed({"places": "p", "events": "e"})
    exact = reports.audit_totals(raw, targets).drop("counts").withColumn("_one", F.lit(1))
    both = about.withColumn("_one", F.lit(1)).join(exact, "_one")
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.033 * F.col(b) + 1
    return both.select(close("p", "places").alias("places_close"), close("e", "events").alias("events_close"), "counts")


def kept_star(spark, sf_dir, layout):
    """The star written into a warehouse of that layout, as a slice reads it."""
    from fieldstar.session import staging_path
    from fieldstar.sinks.tables import Warehouse

    warehouse = Warehouse(spark, staging_path(spark, "warehouse"), layout)
    tables = star(spark, sf_dir)
    for name in ("taxa", "places", "events", "counts"):
        warehouse.append(tables[name], name)
    return warehouse


@query("slice_cells", JSON_SLICE)
def slice_cells(spark, sf_dir):
    """The slice out of files cut along the curve, with the blob's key in a column of its own."""
    from fieldstar.sinks.layout import Layout

    warehouse = kept_star(spark, sf_dir, Layout({"events": ["STATUS"]}, cells=True))
    return reports.slice_json(warehouse.tables(beside=True), None, "STATUS", "status", YEAR, DAYS, LNG, LAT)


@query("slice_bucketed", JSON_SLICE)
def slice_bucketed(spark, sf_dir):
    """The slice out of events and counts in buckets."""
    from fieldstar.session import staging_path
    from fieldstar.sinks.buckets import BucketedStar

    copy = BucketedStar(spark, staging_path(spark, "buckets"))
    copy.write(star(spark, sf_dir), 8)
    return reports.slice_json(copy.tables(), None, "STATUS", "status", YEAR, DAYS, LNG, LAT)


EXTRACT = """
select GLOBAL_UNIQUE_IDENTIFIER, SCIENTIFIC_NAME, cast(LONGITUDE as double) as LONGITUDE,
  cast(LATITUDE as double) as LATITUDE, cast(try_cast(OBSERVATION_DATE as date) as string) as seen,
  APPROVED, ALL_SPECIES_REPORTED, OBSERVATION_COUNT
from {raw_obs} where LONGITUDE <> 'bad' and try_cast(LONGITUDE as double) between -90 and -60
  and try_cast(LATITUDE as double) between 25 and 50
"""


def extract(spark, sf_dir, **clauses):
    rows = reports.bbox_extract(view(spark, sf_dir, "raw_obs"), (-60.0, -90.0), (25.0, 50.0), **clauses)
    return rows.select(
        "GLOBAL_UNIQUE_IDENTIFIER",
        "SCIENTIFIC_NAME",
        "LONGITUDE",
        "LATITUDE",
        F.date_format("OBSERVATION_DATE", "yyyy-MM-dd").alias("seen"),
        "APPROVED",
        "ALL_SPECIES_REPORTED",
        "OBSERVATION_COUNT",
    )


@query(
    "bbox_extract_strict",
    f"{EXTRACT} and APPROVED = '1' and ALL_SPECIES_REPORTED = '1' and OBSERVATION_DATE <> 'unknown'",
)
def bbox_extract_strict(spark, sf_dir):
    return extract(spark, sf_dir)


@query("bbox_extract_loose", EXTRACT)
def bbox_extract_loose(spark, sf_dir):
    return extract(spark, sf_dir, require_date=False, require_approved=False, require_complete=False)


@query(
    "coord_clean",
    """select GLOBAL_UNIQUE_IDENTIFIER, try_cast(LONGITUDE as double) as LONGITUDE,
    try_cast(LATITUDE as double) as LATITUDE from {raw_obs}
    where try_cast(LONGITUDE as double) between -180 and 180 and try_cast(LATITUDE as double) between -90 and 90""",
)
def coord_clean(spark, sf_dir):
    rows = view(spark, sf_dir, "raw_obs").select("GLOBAL_UNIQUE_IDENTIFIER", "LONGITUDE", "LATITUDE")
    return bbox(rows, "LONGITUDE", "LATITUDE")


@query(
    "quality_gate",
    """select GLOBAL_UNIQUE_IDENTIFIER, OBSERVATION_DATE, cast(year(cast(OBSERVATION_DATE as date)) as int) as year
    from {raw_obs} where APPROVED = '1' and ALL_SPECIES_REPORTED = '1' and OBSERVATION_DATE <> 'unknown'""",
)
def quality_gate_query(spark, sf_dir):
    rows = quality_gate(view(spark, sf_dir, "raw_obs"))
    return rows.select("GLOBAL_UNIQUE_IDENTIFIER", "OBSERVATION_DATE", F.year("date").alias("year"))


@query(
    "precision_gate",
    """select GLOBAL_UNIQUE_IDENTIFIER, EFFORT_DISTANCE_KM from {raw_obs}
    where EFFORT_DISTANCE_KM is null or EFFORT_DISTANCE_KM not in ('1.5', '7.5')""",
)
def precision_gate(spark, sf_dir):
    rows = not_coded(view(spark, sf_dir, "raw_obs"), "EFFORT_DISTANCE_KM", ["1.5", "7.5"])
    return rows.select("GLOBAL_UNIQUE_IDENTIFIER", "EFFORT_DISTANCE_KM")


@query(
    "required_fields",
    """select GLOBAL_UNIQUE_IDENTIFIER, EFFORT_DISTANCE_KM, DURATION_MINUTES, LATITUDE from {raw_obs}
    where LATITUDE is not null and (EFFORT_DISTANCE_KM is not null or DURATION_MINUTES is not null)""",
)
def required_fields(spark, sf_dir):
    from fieldstar.operators.filters import require

    rows = require(view(spark, sf_dir, "raw_obs"), ["LATITUDE"], ["EFFORT_DISTANCE_KM", "DURATION_MINUTES"])
    return rows.select("GLOBAL_UNIQUE_IDENTIFIER", "EFFORT_DISTANCE_KM", "DURATION_MINUTES", "LATITUDE")


@query(
    "dataset_volumes",
    """select dataset_id, cast(coalesce(p.n, 0) as bigint) as places, cast(coalesce(v.n, 0) as bigint) as events,
      cast(coalesce(c.n, 0) as bigint) as counts
    from (select dataset_id, count(*) as n from {places} group by 1) p
    full join (select dataset_id, count(*) as n from {visits} group by 1) v using (dataset_id)
    full join (select dataset_id, count(*) as n from {tallies} group by 1) c using (dataset_id)""",
)
def dataset_volumes(spark, sf_dir):
    return reports.dataset_volumes(star(spark, sf_dir))
