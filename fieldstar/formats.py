"""Fixed values of the source formats.

Everything here must equal what the sources and the conformed tables use:
dataset ids and titles, raw column names, the fields packed into each JSON
blob (in order), precision codes and their radii, and default bounds.
"""

from __future__ import annotations

# Registry rows of the datasets, in ingest order.
DATASETS = {
    "clements": {
        "dataset_id": "clements",
        "title": "eBird Clements integrated checklists",
        "version": "August 2018",
        "url": "https://www.birdpop.org/pages/birdSpeciesCodes.php",
    },
    "bbs": {
        "dataset_id": "bbs",
        "title": "North American Breeding Bird Survey (BBS)",
        "version": "2016.0",
        "url": "https://www.pwrc.usgs.gov/bbs/",
    },
    "maps": {
        "dataset_id": "maps",
        "title": "MAPS: Monitoring Avian Productivity and Survivorship",
        "version": "2019.0",
        "url": "https://www.birdpop.org/pages/maps.php",
    },
    "nestwatch": {"dataset_id": "nestwatch", "title": "Nestwatch", "version": "2020-10-14", "url": ""},
    "pollard": {
        "dataset_id": "pollard",
        "title": "Pollard lepidoptera observations",
        "version": "2018-02",
        "url": "",
    },
    "naba": {"dataset_id": "naba", "title": "NABA", "version": "2018-07-04", "url": ""},
    "caterpillar": {
        "dataset_id": "caterpillar",
        "title": "Caterpillar Counts",
        "version": "2018-09-18",
        "url": "https://caterpillarscount.unc.edu/iuFYr1xREQOp2ioB5MHvnCTY39UHv2/",
    },
    "bbl": {
        "dataset_id": "bbl",
        "title": "Bird Banding Laboratory (BBL)",
        "version": "2020.0",
        "url": "https://www.usgs.gov/centers/pwrc/science/bird-banding-laboratory",
    },
    "ebird": {
        "dataset_id": "ebird",
        "title": "ebd_relMay-2020.txt.gz",
        "version": "relMay-2020",
        "url": "https://ebird.org/home",
    },
}

# Classes of taxa.
BIRDS = "aves"
BUTTERFLIES = "lepidoptera"

# Base taxonomy columns and blob fields.
TAXONOMY_RENAMES = {"scientific name": "sci_name", "English name": "common_name", "eBird species group": "group"}
TAXONOMY_JSON = "eBird_species_code_2018 sort_v2018 range extinct"
SPECIES_CODE_KEY = "eBird_species_code_2018"

# Checklist columns, box and blob fields.
CHECKLIST_RENAMES = {
    "LONGITUDE": "lng",
    "LATITUDE": "lat",
    "EFFORT_DISTANCE_KM": "radius",
    "TIME_OBSERVATIONS_STARTED": "started",
    "OBSERVATION_COUNT": "count",
}
CHECKLIST_LNG, CHECKLIST_LAT = (-95.0, -50.0), (20.0, 90.0)
CHECKLIST_PLACE_JSON = (
    "COUNTRY_CODE STATE_CODE COUNTY_CODE IBA_CODE BCR_CODE USFWS_CODE ATLAS_BLOCK LOCALITY_ID LOCALITY_TYPE "
    "EFFORT_AREA_HA"
)
CHECKLIST_EVENT_JSON = (
    "SAMPLING_EVENT_IDENTIFIER EFFORT_AREA_HA APPROVED REVIEWED NUMBER_OBSERVERS ALL_SPECIES_REPORTED "
    "OBSERVATION_DATE GROUP_IDENTIFIER DURATION_MINUTES PROTOCOL_TYPE PROTOCOL_CODE PROJECT_CODE TRIP_COMMENTS"
)
CHECKLIST_COUNT_JSON = (
    "SCIENTIFIC_NAME GLOBAL_UNIQUE_IDENTIFIER LAST_EDITED_DATE TAXONOMIC_ORDER CATEGORY "
    "SUBSPECIES_SCIENTIFIC_NAME BREEDING_BIRD_ATLAS_CODE BREEDING_BIRD_ATLAS_CATEGORY AGE_SEX OBSERVER_ID "
    "HAS_MEDIA SPECIES_COMMENTS"
)
MISSED_SPECIES = ("Ammospiza caudacuta", "Ammospiza nelsoni")

# Survey route blob fields and the routes' radius (25 miles in metres).
ROUTE_RADIUS = 1609.344 * 25
ROUTE_TAXON_JSON = "species_id aou french_common_name spanish_common_name"
ROUTE_PLACE_JSON = "countrynum statenum route routename active stratum bcr routetypeid routetypedetailid"
ROUTE_EVENT_JSON = (
    "routedataid countrynum statenum route rpid month day obsn totalspp starttemp endtemp tempscale startwind "
    "endwind startsky endsky assistant runtype"
)
ROUTE_COUNT_JSON = (
    "record_id countrynum statenum route rpid year aou count10 count20 count30 count40 count50 stoptotal"
)

# Station blob fields, and radius in metres per precision code.
STATION_PLACE_JSON = (
    "STATION LOC STA STA2 NAME LHOLD HOLDCERT O NEARTOWN COUNTY STATE US REGION BLOCK LATITUDE LONGITUDE "
    "PRECISION SOURCE DATUM DECLAT DECLNG NAD83 ELEV STRATUM BCR HABITAT REG PASSED"
)
STATION_EVENT_JSON = "STA NET DATE STATION LENGTH"
STATION_COUNT_JSON = (
    "LOC BI BS PG C OBAND BAND SSN NUMB OSP SPEC OSP6 SPEC6 OA OHA AGE HA OWRP WRP OS OHS SEX HS SK CP BP F BM "
    "FM FW JP WNG WEIGHT STATUS DATE TIME STA STATION NET ANET DISP NOTE PPC SSC PPF SSF TT RR HD UPP UNP BPL NF "
    "FP SW COLOR SC CC BC MC WC JC OV1 V1 VM V94 V95 V96 V97 OVYR VYR N B A YS"
)
STATION_RADIUS = {
    30.92: ("01S",),
    30.92 * 5: ("05S",),
    30.92 * 10: ("10S",),
    111.32 * 1000: ("01M",),
    111.32 * 1000 * 10: ("10M", "BLK"),
}

# Nest attempt dates, the measures of each date, and blob fields.
NEST_DATES = {"FIRST_LAY_DT": "lay_date", "HATCH_DT": "hatch_date", "FLEDGE_DT": "fledge_date"}
NEST_MEASURES = {
    "CLUTCH_SIZE_HOST_ATLEAST": "FIRST_LAY_DT",
    "EGGS_HOST_UNH_ATLEAST": "HATCH_DT",
    "YOUNG_HOST_TOTAL_ATLEAST": "HATCH_DT",
    "YOUNG_HOST_FLEDGED_ATLEAST": "FLEDGE_DT",
    "YOUNG_HOST_DEAD_ATLEAST": "FLEDGE_DT",
}
NEST_PLACE_JSON = "LOC_ID SUBNATIONAL1_CODE ELEVATION_M HEIGHT_M REL_TO_SUBSTRATE SUBSTRATE_CODE"
NEST_EVENT_JSON = (
    "LOC_ID CAVITY_ENTRANCE_DIAM_CM FIRST_LAY_DT HATCH_DT FLEDGE_DT ENTRANCE_ORIENTATION HABITAT_CODE_1 "
    "HABITAT_CODE_2 HABITAT_CODE_3 PROJ_PERIOD_ID USER_ID OUTCOME_CODE_LIST ATTEMPT_ID place_id event_type"
)
NEST_COUNT_JSON = "SPECIES_CODE taxon_id count_type"

# Transect blob fields.
TRANSECT_PLACE_JSON = (
    "Site Route County State Land_Owner transect_id Route_Poin Route_Po_1 Route_Po_2 CLIMDIV_ID CD_sub CD_Name ST "
    "PRE_MEAN PRE_STD TMP_MEAN TMP_STD"
)
TRANSECT_EVENT_JSON = (
    "Site Route County State Start_time End_time Duration Survey Temp Sky Wind Archived Was_the_survey_completed "
    "Monitoring_Program Date Temperature_end Sky_end Wind_end"
)
TRANSECT_COUNT_JSON = (
    "A B C D E A_key B_key C_key D_key E_key Observer_Spotter Other_participants Recorder_Scribe Taxon_as_reported"
)

# July count blob fields.
JULY_TAXON_JSON = "SPECIES_CODE Gen_Tribe_Fam Species"
JULY_PLACE_JSON = "SITE_ID"
JULY_EVENT_JSON = "iYear Month Day PARTY_HOURS"

# Arthropod survey blob fields.
ARTHROPOD_PLACE_JSON = "ID Name Description Region"
ARTHROPOD_EVENT_JSON = (
    "ID_survey ID_plant SiteFK Circle Orientation Code Species SubmissionTimestamp LocalDate LocalTime "
    "ObservationMethod Notes WetLeaves PlantSpecies NumberOfLeaves AverageLeafLength HerbivoryScore "
    "SubmittedThroughApp MinimumTemperature MaximumTemperature"
)
ARTHROPOD_COUNT_JSON = "ID SurveyFK Length PhotoURL Notes Hairy Rolled Tented"

# Band record columns per kind of record, blob fields, precision codes.
BAND_KINDS = {
    "banding": {
        "lng": "LON_DECIMAL_DEGREES",
        "lat": "LAT_DECIMAL_DEGREES",
        "date": "BANDING_DATE",
        "species": "SPECIES_ID",
        "precision": "COORD_PRECISION",
        "event_json": "BAND_NUM BANDING_DATE TYPE",
        "count_json": "AGE_CODE SEX_CODE SPECIES_ID SPECIES_NAME TYPE",
    },
    "encounter": {
        "lng": "E_LON_DECIMAL_DEGREES",
        "lat": "E_LAT_DECIMAL_DEGREES",
        "date": "ENCOUNTER_DATE",
        "species": "B_SPECIES_ID",
        "precision": "E_COORD_PRECISION",
        "event_json": "BAND_NUM ENCOUNTER_DATE TYPE",
        "count_json": "B_AGE_CODE B_SEX_CODE B_SPECIES_ID B_SPECIES_NAME MIN_AGE_AT_ENC ORIGINAL_BAND TYPE",
    },
}
BAND_KINDS["recapture"] = BAND_KINDS["encounter"]
BAND_CODE_COLUMNS = ("Scientific Name", "Species Number")
BAND_TOO_COARSE = ("12", "72")  # country, state
BAND_RADIUS = {0.0: ("0",), 111.32 * 1000: ("1", "60")}
BAND_RADIUS_DEFAULT = 111.32 * 1000 * 10

# Card files with their quote character and column count.
CARD_FILES = {
    "NABPP_2": ("'", 6),
    "NABPP_adm1": ('"', 5),
    "NABPP_cagns": ('"', 9),
    "NABPP_discrepancy1": ("'", 18),
    "NABPP_downloads": ("'", 5),
    "NABPP_gnis": ("'", 19),
    "NABPP_location1": ("'", 7),
    "NABPP_obs_alias": ("'", 2),
    "NABPP_observations": ("'", 37),
    "NABPP_observer": ("'", 12),
    "NABPP_rectifiable": ("'", 3),
    "NABPP_rect_import": ("'", 26),
    "NABPP_rect_listtest": ("'", 1),
    "NABPP_rect_test": ("'", 5),
    "NABPP_species_matched": ('"', 9),
    "NABPP_species": ('"', 4),
    "NABPP_transcriber": ("'", 20),
    "NABPP_transcription": ("'", 26),
    "NABPP_validatable": ("'", 3),
    "NABPP_validated_obs_vw": ('"', 3),
}
METADATA_COLUMNS = "table column primary_key foreign_key1 foreign_key2 foreign_key3"

# Report columns of the missing-names report.
MISSING_COLUMNS = "dataset sci_name common_name key"

# Cell texts that mean "missing" in the raw files.
NA_TOKENS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
