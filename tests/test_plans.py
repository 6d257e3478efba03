"""All datasets ingested from tiny raw files into one warehouse."""

import json

import pytest
from pyspark.sql import functions as F

from fieldstar.formats import DATASETS
from fieldstar.operators.constraints import check_constraints
from fieldstar.plans import reports
from fieldstar.plans.checklists import backfill_species
from fieldstar.plans.run_all import ingest, run_all
from fieldstar.sinks.tables import Warehouse

ORDER = ["ord"]


def raw(spark, header, *lines):
    """Text rows with their position as the row order."""
    names = header.split(",")
    data = [(i, *[c if c != "" else None for c in line.split(",")]) for i, line in enumerate(lines)]
    return spark.createDataFrame(data, "ord int, " + ", ".join(f"`{n}` string" for n in names))


def sources(spark):
    return {
        "clements": {
            "taxonomy": raw(
                spark,
                "scientific name,English name,eBird species group,order,eBird species code 2018,range",
                "Larus  argentatus,Herring Gull,Gulls,Charadriiformes,hergul,coast",
                "Ammospiza nelsoni,Nelson's Sparrow,Sparrows,Passeriformes,nelspa,",
                "Larus argentatus,again,Gulls,,x,",
            ),
            "targets": raw(spark, "sci_name", "Ammospiza nelsoni", "Larus argentatus"),
        },
        "bbs": {
            "species": raw(
                spark,
                "genus,species,english_common_name,sporder,family,species_id,aou",
                "Larus,argentatus,Herring Gull,C,L,1,510",
                "Corvus,corax / sp,Raven,P,Corvidae,2,4860",
            ),
            "routes": raw(
                spark,
                "countrynum,statenum,route,routename,longitude,latitude",
                "840,2,1,One,-86.5,33.5",
                "124,2,1,Other country,-100,50",
            ),
            "weather": raw(
                spark,
                "countrynum,statenum,route,rpid,year,month,day,starttime,endtime",
                "840,2,1,101,2014,4,10,505,1003",
                "124,2,1,101,2014,6,1,,9999",
            ),
            "counts": raw(
                spark,
                "countrynum,statenum,route,rpid,year,aou,speciestotal,record_id",
                "840,2,1,101,2014,510,7,1",
                "124,2,1,101,2014,4860,,2",
                "124,2,1,101,2014,9999,3,3",
                "840,2,9,101,2014,510,3,4",
            ),
        },
        "maps": {
            "species": raw(spark, "SPEC,SCINAME,COMMONNAME", "HERG,Larus argentatus,Gull", "XXXX,New  bird,New"),
            "stations": raw(
                spark,
                "STA,NAME,DECLNG,DECLAT,PRECISION",
                "11111,Pond,-80.5,40.5,01M",
                "22222,Nowhere,bad,40.5,BLK",
                "333,Short,-80,40,BLK",
            ),
            "effort": raw(spark, "STA,NET,DATE,START,END,LENGTH", "11111,01,2018-05-01,053,112,12", "11111,,2018-05-02,060,,9"),
            "status": raw(spark, "YR,STA,SPEC,YS", "2018,11111,HERG,B", "2018,11111,HERG,T"),
            "bands": raw(
                spark,
                "STA,NET,DATE,STATION,SPEC,BAND",
                "11111,01,2018-05-01,POND,HERG,1",
                "11111,01,2018-05-01,POND,XXXX,2",
                "11111,,2018-05-02,POND,HERG,3",
                "22222,01,2018-05-02,NOWH,HERG,4",
                "11111,01,2018-05-01,POND,ZZZZ,5",
            ),
        },
        "nestwatch": {
            "attempts": raw(
                spark,
                "ATTEMPT_ID,LOC_ID,SPECIES_CODE,LONGITUDE,LATITUDE,FIRST_LAY_DT,HATCH_DT,FLEDGE_DT,"
                "CLUTCH_SIZE_HOST_ATLEAST,YOUNG_HOST_TOTAL_ATLEAST,HABITAT_CODE_1",
                "A1,L1,hergul,-70,41,04MAY2012:00:00:00,,,9,,",
                "A1,L1,hergul,-70,41,,20MAY2012:00:00:00,,10,3,dune",
                "A2,L1,nelspa,-70,41,04MAY2099:00:00:00,,,,,",
                "A3,L2,hergul,x,41,04MAY2012:00:00:00,,,4,,",
                "A4,L3,unknown,-70,41,04MAY2012:00:00:00,,,4,,",
            )
        },
        "pollard": {
            "places": raw(spark, "Site,Route,long,lat,Land Owner", "S1,R1,-78.5,36.1,State", "S2,R1,?,36,None"),
            "observations": raw(
                spark,
                "Site,Route,County,State,Start time,End time,Scientific Name,Species,Total",
                "S1,R1,Wake,NC,4/9/2014 10:05,4/9/2014 11:00,Cercyonis  pegala,Wood Nymph,4",
                "S1,R1,Wake,NC,4/9/2014 10:05,,Papilio troilus,Spicebush,",
                "S2,R1,Wake,NC,4/9/2014 10:05,,Papilio troilus,Spicebush,1",
                "S1,R1,Wake,NC,someday,,Papilio troilus,Spicebush,1",
            ),
        },
        "naba": {
            "observations": raw(
                spark,
                "LATITUDE,LONGITUDE,iYear,Month,Day,SumOfBFLY_COUNT,Gen/Tribe/Fam,Species,SPECIES_CODE,SITE_ID,PARTY_HOURS",
                "40.5,-75,2010,7,4,12.0,Cercyonis,pegala,CP,9,3",
                "41.5,-76,2010.0,7,4,,Danaus,plexippus,DP,8,2",
                "40.5,-75,2010,7,4,1,Danaus,,DP,9,3",
                "40.5,-75,,7,4,1,Danaus,plexippus,DP,9,3",
                "40.5,-75,2010,7,4,2,Danaus,plexippus,DP,9,3",
            )
        },
        "bbl": {
            "codes": raw(spark, "sci_name,species_id", "Larus argentatus,510", "Nobody knows,600"),
            "banding": raw(
                spark,
                "BAND_NUM,BANDING_DATE,SPECIES_ID,LON_DECIMAL_DEGREES,LAT_DECIMAL_DEGREES,COORD_PRECISION,AGE_CODE",
                "1,05/01/2001,0510,-80,40,0,4",
                "2,05/01/2001,0510,-80,40,10,4",
                "3,05/01/2001,0510,-80,40,72,4",
                "4,never,0510,-80,40,0,4",
                "5,05/01/2001,0600,-80,40,0,4",
                "6,05/01/2001,0510,-800,40,0,4",
            ),
            "encounter": raw(
                spark,
                "BAND_NUM,ENCOUNTER_DATE,B_SPECIES_ID,E_LON_DECIMAL_DEGREES,E_LAT_DECIMAL_DEGREES,E_COORD_PRECISION",
                "1,06/01/2002,0510,-80,40,0",
            ),
            "recapture": raw(
                spark,
                "BAND_NUM,ENCOUNTER_DATE,B_SPECIES_ID,E_LON_DECIMAL_DEGREES,E_LAT_DECIMAL_DEGREES,E_COORD_PRECISION",
                "1,06/01/2003,0510,-81,40,60",
            ),
        },
        "ebird": {"checklists": raw(spark, CHECKLIST_HEADER, *CHECKLISTS)},
        "caterpillar": {
            "sites": raw(spark, "ID,Name,Longitude,Latitude", "1,Wood,-79,35.9"),
            "plants": raw(spark, "ID,SiteFK,Code", "10,1,AAA"),
            "surveys": raw(spark, "ID,PlantFK,LocalDate,LocalTime", "100,10,2018-07-01,09:30:12"),
            "records": raw(spark, "ID,SurveyFK,Group,Quantity", "1,100,ant,5", "2,100,ant,", "3,100,bee,2", "4,7,bee,2"),
        },
    }


CHECKLIST_HEADER = (
    "GLOBAL UNIQUE IDENTIFIER,SAMPLING EVENT IDENTIFIER,SCIENTIFIC NAME,LONGITUDE,LATITUDE,OBSERVATION DATE,"
    "OBSERVATION COUNT,APPROVED,ALL SPECIES REPORTED,EFFORT DISTANCE KM,TIME OBSERVATIONS STARTED,DURATION MINUTES"
)
CHECKLISTS = (
    "u1,S1,Larus argentatus,-72.5,40.5,2014-04-10,X,1,1,1.5,23:30:00,90",
    "u2,S1,Ammospiza nelsoni,-72.5,40.5,2014-04-10,3,1,1,1.5,23:30:00,90",
    "u3,S1,Corvus brachyrhynchos,-72.5,40.5,2014-04-10,9,1,1,1.5,23:30:00,90",
    "u4,S2,Corvus brachyrhynchos,-72.5,40.5,2014-04-11,9,1,1,,,",
    "u5,S3,Larus argentatus,-71.5,40.5,2014-04-11,lots,1,1,x,06:00:00,",
    "u6,S4,Larus argentatus,-71.5,40.5,2014-04-11,1,0,1,,,",
    "u7,S5,Larus argentatus,-120,40.5,2014-04-11,1,1,1,,,",
)


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("all")))
    made = run_all(spark, warehouse, sources(spark), as_of_year=2020, order=ORDER)
    return warehouse, made


def of(warehouse, table, dataset_id):
    return warehouse.load(table).filter(F.col("dataset_id") == dataset_id)


def test_all_datasets_hold_the_declared_constraints(filled):
    warehouse, made = filled
    assert list(made) == ["clements", "bbs", "maps", "nestwatch", "pollard", "naba", "bbl", "ebird"]
    assert [tuple(r) for r in check_constraints(warehouse.tables()).collect()] == []
    assert {r.dataset_id for r in warehouse.load("datasets").collect()} == set(DATASETS) - {"caterpillar"}


def test_taxonomy(filled, rows):
    taxa = filled[0].load("taxa")
    birds = taxa.filter("class = 'aves' and target")
    assert rows(birds, "taxon_id", "sci_name", "genus", "group") == [
        (1, "Larus argentatus", "Larus", "Gulls"),
        (2, "Ammospiza nelsoni", "Ammospiza", "Sparrows"),
    ]
    blob = json.loads(taxa.filter("taxon_id = 1").first()["taxon_json"])
    assert blob == {"eBird_species_code_2018": "hergul", "range": "coast", "species_id": "1", "aou": "510"}
    assert taxa.filter("sci_name = 'Corvus corax/sp'").count() == 1
    assert taxa.filter("taxon_id = 1").first()["spec"] == "HERG"


def test_survey_routes(filled, rows):
    warehouse = filled[0]
    events = of(warehouse, "events", "bbs")
    assert rows(events, "year", "day", "started", "ended") == [(2014, 100, "05:05", "10:03"), (2014, 152, "", None)]
    counts = of(warehouse, "counts", "bbs").join(events.select("event_id", "place_id"), "event_id")
    assert rows(counts, "count", "taxon_id") == [(0, 3), (7, 1)]
    assert counts.select("place_id").distinct().count() == 2


def test_banding_stations(filled, rows):
    warehouse = filled[0]
    assert rows(of(warehouse, "places", "maps"), "lng", "lat", "radius") == [(-80.5, 40.5, 111320.0)]
    assert rows(of(warehouse, "events", "maps"), "day", "started", "ended") == [
        (121, "05:30", "11:20"),
        (122, "06:00", "00:00"),
    ]
    counts = of(warehouse, "counts", "maps")
    assert [json.loads(r.count_json).get("YS") for r in counts.orderBy("count_id").collect()] == ["B", None, "B"]
    assert counts.join(warehouse.load("taxa"), "taxon_id").filter("sci_name = 'New bird'").count() == 1


def test_nest_attempts(filled, rows):
    warehouse = filled[0]
    assert of(warehouse, "places", "nestwatch").count() == 1
    assert rows(of(warehouse, "events", "nestwatch"), "year", "day") == [(1999, 124), (2012, 125), (2012, 141)]
    assert rows(of(warehouse, "counts", "nestwatch"), "count") == [(10,), (3,)]
    blobs = [json.loads(r.event_json) for r in of(warehouse, "events", "nestwatch").orderBy("event_id").collect()]
    assert blobs[0]["event_type"] == "FIRST_LAY_DT" and blobs[0]["HABITAT_CODE_1"] == "dune"


def test_transects(filled, rows):
    warehouse = filled[0]
    place = of(warehouse, "places", "pollard").first()
    assert json.loads(place.place_json) == {"Site": "S1", "Route": "R1", "County": "Wake", "State": "NC", "Land_Owner": "State"}
    assert rows(of(warehouse, "events", "pollard"), "year", "day", "started", "ended") == [
        (2014, 99, "10:05", "11:00"),
        (2014, 99, "10:05", None),
    ]
    assert rows(of(warehouse, "counts", "pollard"), "count") == [(0,), (4,)]


def test_july_counts(filled, rows):
    warehouse = filled[0]
    assert rows(of(warehouse, "events", "naba"), "year", "day") == [(2010, 185), (2010, 185)]
    assert rows(of(warehouse, "counts", "naba"), "count") == [(0,), (12,), (2,)]
    taxa = warehouse.load("taxa").filter("sci_name = 'Cercyonis pegala'")
    assert json.loads(taxa.first()["taxon_json"])["SPECIES_CODE"] == "CP" and taxa.count() == 1


def test_band_records(filled, rows):
    warehouse = filled[0]
    assert rows(of(warehouse, "places", "bbl"), "lng", "lat", "radius") == [
        (-80.0, 40.0, 0.0),
        (-80.0, 40.0, 1113200.0),
        (-81.0, 40.0, 111320.0),
    ]
    assert rows(of(warehouse, "counts", "bbl"), "count") == [(1,)] * 4
    kinds = [json.loads(r.event_json)["TYPE"] for r in of(warehouse, "events", "bbl").orderBy("event_id").collect()]
    assert kinds == ["banding", "banding", "encounter", "recapture"]


def test_checklists(filled, rows):
    warehouse, made = filled
    assert rows(of(warehouse, "places", "ebird"), "lng", "radius") == [(-71.5, 0.0), (-72.5, 1500.0)]
    assert rows(of(warehouse, "events", "ebird"), "day", "started", "ended") == [
        (100, "23:30", "01:00"),
        (101, "06:00", None),
        (101, None, None),
    ]
    assert rows(of(warehouse, "counts", "ebird"), "count") == [(-1,), (3,)]
    assert made["ebird"]["rejects"].count() == 1


def test_audit_agrees_with_the_ingest(spark, filled):
    warehouse, made = filled
    from fieldstar.operators.columns import normalize_columns

    checklists = normalize_columns(sources(spark)["ebird"]["checklists"])
    targets = warehouse.load("taxa").filter("target").select("sci_name")
    total = reports.audit_totals(checklists, targets).first()
    assert total.places == of(warehouse, "places", "ebird").count()
    assert total.events == of(warehouse, "events", "ebird").count()
    assert total.counts == of(warehouse, "counts", "ebird").count() + made["ebird"]["rejects"].count()


def test_backfill_only_on_known_events(spark, filled, rows):
    warehouse = filled[0]
    late = raw(
        spark,
        CHECKLIST_HEADER,
        "u8,S2,Ammospiza nelsoni,-72.5,40.5,2014-04-11,2,1,1,,,",
        "u9,S99,Ammospiza nelsoni,-72.5,40.5,2014-04-11,2,1,1,,,",
        "u10,S2,Larus argentatus,-72.5,40.5,2014-04-11,2,1,1,,,",
    )
    made = backfill_species(spark, {"checklists": late}, warehouse.tables(), order=ORDER)
    assert rows(made["counts"], "count", "taxon_id") == [(2, 2)]
    assert made["counts"].first()["count_id"] > warehouse.load("counts").agg(F.max("count_id")).first()[0]


def test_reingest_replaces_and_optional_plan_runs_by_name(spark, filled):
    warehouse = filled[0]
    before = {t: warehouse.load(t).count() for t in ("taxa", "places", "events", "counts")}
    ingest(spark, warehouse, "bbs", sources(spark)["bbs"], order=ORDER)
    assert {t: warehouse.load(t).count() for t in before} == before
    run_all(spark, warehouse, sources(spark), datasets=["caterpillar"], order=ORDER)
    assert of(warehouse, "counts", "caterpillar").count() == 2
    event = of(warehouse, "events", "caterpillar").first()
    assert (event.year, event.day, event.started) == (2018, 182, "09:30")
    assert [tuple(r) for r in check_constraints(warehouse.tables()).collect()] == []


def test_volumes(filled, rows):
    volumes = {r[0]: tuple(r)[1:] for r in reports.dataset_volumes(filled[0].tables()).collect()}
    assert volumes["ebird"] == (2, 3, 2) and volumes["maps"] == (1, 2, 3)
