"""Sinks, exchange formats, streams and binary sources, through real files."""

import struct
import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import pieces, query, shuffled, table, view
from fieldstar.schema import conform
from fieldstar.session import file_states, list_paths, staging_path
from fieldstar.sinks.files import export_csv, import_tables
from fieldstar.sinks.tables import Warehouse
from fieldstar.sources.dbf import read_dbf
from fieldstar.streaming import ingest

PLACE_TEXTS = """
case when c_custkey % 7 = 0 then null when c_custkey % 5 = 0 then '' when c_custkey % 3 = 0
  then concat(' a "quoted", ', c_mktsegment, chr(10), 'line ')
  else concat('{{"SEGMENT":"', c_mktsegment, '"}}') end
"""


def written_places(spark, sf_dir):
    places = view(spark, sf_dir, "places")
    segment, k = F.col("precision_code"), F.col("place_id")
    text = (
        F.when(k % 7 == 0, None)
        .when(k % 5 == 0, F.lit(""))
        .when(k % 3 == 0, F.concat(F.lit(' a "quoted", '), segment, F.lit("\nline ")))
        .otherwise(F.concat(F.lit('{"SEGMENT":"'), segment, F.lit('"}')))
    )
    return conform(places.withColumn("place_json", text), "places")


@query(
    "export_import_roundtrip",
    f"""select place_id, p.dataset_id, lng, lat, {PLACE_TEXTS} as place_json
    from {{places}} p join {{customer}} on place_id = c_custkey""",
)
def export_import_roundtrip(spark, sf_dir):
    path = staging_path(spark, "export")
    export_csv({"places": written_places(spark, sf_dir)}, "places", path)
    back = import_tables(spark, path, {"places": ["places.csv"]})["places"]
    return back.select("place_id", "dataset_id", "lng", "lat", "place_json")


def written_counts(spark, sf_dir):
    return conform(view(spark, sf_dir, "tallies"), "counts")


@query(
    "export_dataset",
    "select event_id, dataset_id, taxon_id, count from {tallies} where dataset_id = '7'",
)
def export_dataset(spark, sf_dir):
    path = staging_path(spark, "export")
    tables = {
        "places": written_places(spark, sf_dir),
        "events": conform(view(spark, sf_dir, "visits"), "events"),
        "counts": written_counts(spark, sf_dir),
    }
    export_csv(tables, "7", path)
    back = import_tables(spark, path, {"counts": ["counts_7.csv"]})["counts"]
    return back.select("event_id", "dataset_id", "taxon_id", "count")


@query(
    "replace_dataset",
    """select event_id, dataset_id, taxon_id, case when dataset_id = '3' then count + 1000 else count end as count
    from {tallies} where dataset_id <> '5'""",
)
def replace_dataset(spark, sf_dir):
    warehouse = Warehouse(spark, staging_path(spark, "warehouse"))
    counts = written_counts(spark, sf_dir)
    warehouse.append(counts, "counts")
    of = F.col("dataset_id")
    warehouse.replace_dataset(counts.filter(of == "3").withColumn("count", F.col("count") + 1000), "counts", "3")
    warehouse.replace_dataset(counts.filter(of == "no such"), "counts", "5")
    return warehouse.load("counts").select("event_id", "dataset_id", "taxon_id", "count")


@query(
    "load_slice",
    """select event_id, place_id, year, day from {visits} where dataset_id = '7'""",
)
def load_slice(spark, sf_dir):
    warehouse = Warehouse(spark, staging_path(spark, "warehouse"))
    warehouse.append(view(spark, sf_dir, "visits"), "events")
    return warehouse.load("events").filter("dataset_id = '7'").select("event_id", "place_id", "year", "day")


def as_files(df, files=6):
    """The rows as several files of a folder, for a stream to pick up."""
    path = staging_path(df.sparkSession, "incoming")
    df.repartition(files).write.parquet(path)
    return path


def streamed(spark, df, start, columns, files_per_batch=2):
    """Run one stream over the rows and return what it wrote; larger inputs come in more files, not in larger ones."""
    times = pieces(df, 6)
    source = ingest.stream_files(spark, as_files(df, 6 * times), df.schema, "parquet", files_per_batch * times)
    target = staging_path(spark, "target")
    start(source, target, staging_path(spark, "progress")).awaitTermination()
    return ingest.read_target(spark, target, T.StructType.fromDDL(columns)).drop(ingest.BATCH)


def arriving(df, parts, step):
    """Folder that the rows reach part by part, and how many files each part has.

    A part of a small input is one file. Larger inputs come in more files, not
    in larger ones; with as many files to a batch, a part is a batch. Rows that
    a shuffle has dealt already are not moved once more.
    """
    path, files = staging_path(df.sparkSession, "incoming"), pieces(df, step)
    for k in range(step):
        part = df.filter(parts == k)
        part = part.coalesce(files) if shuffled(part) else part.repartition(files)
        part.write.mode("append").parquet(path)
        made = len([n for n in list_paths(df.sparkSession, path) if n.endswith(".parquet")])
        for _ in range(made, files * (k + 1)):  # a part of hardly any rows
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
    return path, files


@query(
    "stream_first_seen",
    """select event_id, user_id, event_type, epoch_us(ts) as seen, value from (
      select *, row_number() over (partition by user_id, event_type order by event_id % 3, ts, event_id) as n
      from {events}) where n = 1""",
)
def stream_first_seen(spark, sf_dir):
    """Whole rows: which one wins goes by file, then by time."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    path, files = arriving(rows, F.col("event_id") % 3, 3)
    source = ingest.stream_files(spark, path, rows.schema, "parquet", files)
    target = staging_path(spark, "target")
    query = ingest.stream_first_seen(
        source, target, staging_path(spark, "progress"), ["user_id", "event_type"], ["ts", "event_id"]
    )
    query.awaitTermination()
    found = ingest.read_target(spark, target, rows.schema)
    return found.select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("seen"), "value")


@query(
    "stream_bbox",
    """select GLOBAL_UNIQUE_IDENTIFIER, cast(LONGITUDE as double) as LONGITUDE, cast(LATITUDE as double) as LATITUDE
    from {raw_obs} where APPROVED = '1' and ALL_SPECIES_REPORTED = '1' and OBSERVATION_DATE <> 'unknown'
      and LONGITUDE <> 'bad' and try_cast(LONGITUDE as double) between -90 and -60
      and try_cast(LATITUDE as double) between 25 and 50""",
)
def stream_bbox(spark, sf_dir):
    def start(source, target, progress):
        return ingest.stream_bbox(source, target, progress, (-90.0, -60.0), (25.0, 50.0))

    columns = "GLOBAL_UNIQUE_IDENTIFIER string, LONGITUDE double, LATITUDE double"
    return streamed(spark, view(spark, sf_dir, "raw_obs"), start, columns)


MISSED = ["red widget 1", "blue plate 7", "hot rod 3", "old anvil 12", "small ring 20", "new gear 33", "cold ring 8"]


@query(
    "stream_backfill",
    f"""select l_orderkey as event_id, taxon_id,
      case when OBSERVATION_COUNT = 'X' then -1 else cast(OBSERVATION_COUNT as int) end as count,
      cast(json_object('SCIENTIFIC_NAME', SCIENTIFIC_NAME, 'GLOBAL_UNIQUE_IDENTIFIER', GLOBAL_UNIQUE_IDENTIFIER)
        as varchar) as count_json, 'ebird' as dataset_id,
      1000 + row_number() over (order by l_orderkey % 3, GLOBAL_UNIQUE_IDENTIFIER) as count_id
    from {{raw_obs}} join {{obs_taxa}} on sci_name = SCIENTIFIC_NAME join {{orders}} on o_orderkey = l_orderkey
    where sci_name in ({', '.join(repr(n) for n in MISSED)}) and o_orderstatus <> 'F'""",
)
def stream_backfill(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    name = F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("SAMPLING_EVENT_IDENTIFIER")
    events = orders.select(F.col("o_orderkey").alias("event_id"), F.to_json(F.struct(name)).alias("event_json"))
    taxa = view(spark, sf_dir, "obs_taxa")

    rows = view(spark, sf_dir, "raw_obs")
    path, files = arriving(rows, F.col("l_orderkey") % 3, 3)
    source = ingest.stream_files(spark, path, rows.schema, "parquet", files)
    target = staging_path(spark, "target")
    query = ingest.stream_backfill(source, target, staging_path(spark, "progress"), events, taxa, MISSED, start=1001)
    query.awaitTermination()
    columns = "count_id long, event_id long, dataset_id string, taxon_id long, `count` int, count_json string"
    return ingest.read_target(spark, target, T.StructType.fromDDL(columns)).drop(ingest.BATCH)


def write_dbf(path, fields):
    """Row batches to DBF files, one per task; returns a mapInPandas function."""

    def write(batches):
        rows = pd.concat([b for b in batches] or [pd.DataFrame(columns=[f for f, _, _ in fields])])
        length = 1 + sum(w for _, _, w in fields)
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{uuid.uuid4().hex}.dbf") as f:
            f.write(struct.pack("<4BLHH20x", 3, 124, 1, 1, len(rows), 32 + 32 * len(fields) + 1, length))
            for name, kind, width in fields:
                f.write(struct.pack("<11sc4xB15x", name.encode(), kind.encode(), width))
            f.write(b"\r")
            for row in rows.itertuples(index=False):
                cells = [str(v).encode("latin-1").ljust(w)[:w] for v, (_, _, w) in zip(row, fields)]
                f.write(b" " + b"".join(cells))
            f.write(b"\x1a")
        yield pd.DataFrame({"rows": [len(rows)]})

    return write


@query(
    "read_dbf",
    """select cast(p_partkey as varchar) as "SPEC", p_name as "COMMONNAME", p_brand as "GENUS",
      '2018-07-' || lpad(cast(p_size % 28 + 1 as varchar), 2, '0') as "DATE" from {part}""",
)
def read_dbf_query(spark, sf_dir):
    path = staging_path(spark, "dbf")
    day = F.concat(F.lit("201807"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"))
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", day.alias("day")).repartition(4)
    fields = [("SPEC", "C", 12), ("COMMONNAME", "C", 40), ("GENUS", "C", 12), ("DATE", "D", 8)]
    rows.mapInPandas(write_dbf(path, fields), "rows long").collect()
    return read_dbf(spark, path, records=300)


@query(
    "read_dbf_union",
    """select cast(p_partkey as varchar) as "SPEC", case when p_partkey % 2 = 0 then p_name end as "COMMONNAME",
      case when p_partkey % 2 = 1 then p_brand end as "GENUS" from {part}""",
)
def read_dbf_union(spark, sf_dir):
    """A folder of files with different columns."""
    path = staging_path(spark, "dbf")
    part = table(spark, sf_dir, "part")
    for rest, column, field in ((0, "p_name", "COMMONNAME"), (1, "p_brand", "GENUS")):
        rows = part.filter(F.col("p_partkey") % 2 == rest).select("p_partkey", column).repartition(2)
        fields = [("SPEC", "C", 12), (field, "C", 40)]
        rows.mapInPandas(write_dbf(path, fields), "rows long").collect()
    return read_dbf(spark, path, records=300).select("SPEC", "COMMONNAME", "GENUS")


def write_lines(spark, line, rows):
    """Lines of text below one header line per file."""

    def with_header(batches):
        yield pd.DataFrame({"value": ["key,priority"]})
        yield from batches

    path = staging_path(spark, "text")
    rows.select(line.alias("value")).repartition(4).mapInPandas(with_header, "value string").write.text(path)
    return path


@query(
    "text_na_tokens",
    """select cast(o_orderkey as varchar) as key, case when o_orderkey % 5 > 2 then o_orderpriority end as priority
    from {orders}""",
)
def text_na_tokens(spark, sf_dir):
    """Tokens that stand for a missing value."""
    from fieldstar.formats import NA_TOKENS
    from fieldstar.sources.text import read_text_table

    token = F.when(F.col("o_orderkey") % 5 == 0, "NA").when(F.col("o_orderkey") % 5 == 1, "n/a")
    cell = token.when(F.col("o_orderkey") % 5 == 2, "NULL").otherwise(F.col("o_orderpriority"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), cell)
    path = write_lines(spark, line, table(spark, sf_dir, "orders"))
    return read_text_table(spark, path, na_values=NA_TOKENS)


@query(
    "text_ragged",
    """select cast(o_orderkey as varchar) as key, case when o_orderkey % 7 > 0 then o_orderpriority end as priority,
      case o_orderkey % 7 when 0 then cast(o_orderkey as varchar)
        when 1 then o_orderkey || ',' || o_orderpriority || ',more' end as malformed from {orders}""",
)
def text_ragged(spark, sf_dir):
    """Rows with too few and too many cells are kept whole."""
    from fieldstar.sources.text import read_text_table

    key = F.col("o_orderkey").cast("string")
    whole = F.concat_ws(",", key, "o_orderpriority")
    line = F.when(F.col("o_orderkey") % 7 == 0, key).when(F.col("o_orderkey") % 7 == 1, F.concat(whole, F.lit(",more")))
    path = write_lines(spark, line.otherwise(whole), table(spark, sf_dir, "orders"))
    return read_text_table(spark, path, ragged="malformed")


@query(
    "text_table",
    """select cast(o_orderkey as varchar) as o_orderkey, o_orderpriority, 'a "b' as note,
      strftime(o_orderdate, '%Y-%m-%d') as seen, 'é' as accent from {orders}""",
)
def text_table(spark, sf_dir):
    """Unquoted, gzipped, Latin-1 tab-separated text, read back as text."""
    from fieldstar.sources.text import read_text_table, spread

    path = staging_path(spark, "tsv")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.lit('a "b').alias("note"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"),
        F.lit("é").alias("accent"),
    )
    writer = rows.write.option("header", True).option("sep", "\t").option("quote", "\u0000")
    writer.option("encoding", "ISO-8859-1").option("escapeQuotes", False).option("compression", "gzip").csv(path)
    return spread(read_text_table(spark, path, sep="\t", quote="", encoding="ISO-8859-1"), 8)


@query(
    "read_many",
    """select "TYPE", cast(l_orderkey as varchar) as order_key, cast(l_linenumber as varchar) as line_number,
      count(*) as n from (select case l_linestatus when 'O' then 'banding' else 'encounter' end as "TYPE", * from {lineitem})
    group by 1, 2, 3""",
)
def read_many_query(spark, sf_dir):
    from fieldstar.sources.text import read_many

    path = staging_path(spark, "families")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order key"), F.col("l_linenumber").alias("line-number"), "l_linestatus"
    )
    for kind, status in (("banding", "O"), ("encounter", "F")):
        part = rows.filter(F.col("l_linestatus") == status).drop("l_linestatus")
        part.write.option("header", True).csv(f"{path}/{kind}")
    stacked = read_many(spark, {k: f"{path}/{k}/*.csv" for k in ("banding", "encounter")})
    return stacked.groupBy("TYPE", "order_key", "line_number").agg(F.count("*").alias("n"))


@query(
    "checklist_volumes",
    """select 'ebird' as dataset_id, count(distinct (lng, lat)) as places,
      count(distinct SAMPLING_EVENT_IDENTIFIER) as events,
      count(*) filter (where SCIENTIFIC_NAME in (select sci_name from {obs_taxa} where target)) as counts
    from {kept_obs}""",
)
def checklist_volumes(spark, sf_dir):
    """The largest dataset ingested into a warehouse, measured from its tables."""
    from checks.views import ROW_ORDER
    from fieldstar.plans.reports import dataset_volumes
    from fieldstar.plans.run_all import ingest as ingest_dataset

    warehouse = Warehouse(spark, staging_path(spark, "warehouse"))
    warehouse.append(view(spark, sf_dir, "obs_taxa"), "taxa")
    ingest_dataset(spark, warehouse, "ebird", {"checklists": view(spark, sf_dir, "raw_obs")}, order=ROW_ORDER)
    return dataset_volumes(warehouse.tables())


@query(
    "rejects_by_reason",
    """select 'counts' as "table", 'count' as reason, count(*) as n from {kept_obs}
    where SCIENTIFIC_NAME in (select sci_name from {obs_taxa} where target) and l_orderkey % 11 = 0""",
)
def rejects_by_reason(spark, sf_dir):
    """Unreadable numbers of birds end in the warehouse's rejects, not in its counts."""
    from checks.views import ROW_ORDER
    from fieldstar.plans.run_all import ingest as ingest_dataset

    warehouse = Warehouse(spark, staging_path(spark, "warehouse"))
    warehouse.append(view(spark, sf_dir, "obs_taxa"), "taxa")
    unreadable = F.when(F.col("l_orderkey") % 11 == 0, F.lit("lots")).otherwise(F.col("OBSERVATION_COUNT"))
    raw = view(spark, sf_dir, "raw_obs").withColumn("OBSERVATION_COUNT", unreadable)
    ingest_dataset(spark, warehouse, "ebird", {"checklists": raw}, order=ROW_ORDER)
    return warehouse.rejects().groupBy("table", "reason").agg(F.count("*").alias("n"))


@query(
    "backfill_species",
    f"""select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as count_id,
      l_orderkey as event_id, taxon_id,
      case when OBSERVATION_COUNT = 'X' then -1 else cast(OBSERVATION_COUNT as int) end as count
    from {{raw_obs}} join {{obs_taxa}} on sci_name = SCIENTIFIC_NAME join {{orders}} on o_orderkey = l_orderkey
    where sci_name in ({', '.join(repr(n) for n in MISSED)}) and o_orderstatus <> 'F'""",
)
def backfill_species_query(spark, sf_dir):
    from checks.views import ROW_ORDER
    from fieldstar.plans.checklists import backfill_species

    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    name = F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("SAMPLING_EVENT_IDENTIFIER")
    events = orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.lit("ebird").alias("dataset_id"),
        F.to_json(F.struct(name)).alias("event_json"),
    )
    empty = Warehouse(spark, staging_path(spark, "warehouse")).tables()
    tables = {**empty, "events": conform(events, "events"), "taxa": conform(view(spark, sf_dir, "obs_taxa"), "taxa")}
    made = backfill_species(spark, {"checklists": view(spark, sf_dir, "raw_obs")}, tables, MISSED, ROW_ORDER)
    return made["counts"].select("count_id", "event_id", "taxon_id", "count")


def split_bytes(spark, folder):
    """Bytes per split that cut a folder's files into many tasks, but no more of them than large input needs."""
    files = [f"{folder}/{n}" for n in list_paths(spark, folder)]
    size = sum(length for _, length, _ in file_states(spark, files))
    return max(1024, min(size // 64, 32 << 20))


@query(
    "import_splits",
    f"""select place_id, p.dataset_id, lng, lat, {PLACE_TEXTS} as place_json, true as many_tasks
    from {{places}} p join {{customer}} on place_id = c_custkey""",
)
def import_splits(spark, sf_dir):
    """One exported file, cells with line breaks and all, imported by several tasks."""
    path, setting = staging_path(spark, "export"), "spark.sql.files.maxPartitionBytes"
    places = written_places(spark, sf_dir).coalesce(1)
    export_csv({"places": places}, "places", path)
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(split_bytes(spark, f"{path}/places.csv")))
    try:
        back = import_tables(spark, path, {"places": ["places.csv"]})["places"]
        splits = spark.read.text(f"{path}/places.csv").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set(setting, before)
    return back.select("place_id", "dataset_id", "lng", "lat", "place_json", F.lit(splits >= 4).alias("many_tasks"))


@query(
    "registry_rows",
    """select cast(n_nationkey as varchar) as dataset_id, case when n_nationkey % 2 = 0 then 'again ' || n_name else n_name end
      as title, 'v1' as version, true as stamped from {nation}""",
)
def registry_rows(spark, sf_dir):
    """Datasets registered, some of them twice: the last row holds."""
    warehouse = Warehouse(spark, staging_path(spark, "warehouse"))
    for row in view(spark, sf_dir, "datasets").orderBy("dataset_id").collect():
        meta = row.asDict()
        warehouse.register_dataset(meta)
        if int(meta["dataset_id"]) % 2 == 0:
            warehouse.register_dataset({**meta, "title": f"again {meta['title']}"})
    stamped = F.col("extracted").isNotNull().alias("stamped")
    return warehouse.load("datasets").select("dataset_id", "title", "version", stamped)


@query(
    "report_read_back",
    """select cast(p_partkey as varchar) as p_partkey, nullif(note, '') as note from (
      select p_partkey, ' "a", ' || p_name || ' ' as note from {part} where p_size <= 25
      union all select p_partkey, case when p_partkey % 2 = 0 then '' else p_brand end from {part} where p_size > 25)""",
)
def report_read_back(spark, sf_dir):
    """Two frames written as one report, and read back as text."""
    from fieldstar.sinks.files import write_report
    from fieldstar.sources.text import read_text_table

    part, path = table(spark, sf_dir, "part"), staging_path(spark, "report")
    noted = F.concat(F.lit(' "a", '), "p_name", F.lit(" "))
    small = part.filter("p_size <= 25").select("p_partkey", noted.alias("note"))
    large = part.filter("p_size > 25").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "").otherwise(F.col("p_brand")).alias("note"))
    write_report([small, large], path)
    return read_text_table(spark, path).select("p_partkey", F.nullif("note", F.lit("")).alias("note"))


@query(
    "text_typed",
    """select o_orderkey, case when o_orderkey % 7 = 0 then null else cast(o_totalprice as double) end as price,
      cast(o_orderdate as date) = cast(o_orderdate as date) as dated from {orders}""",
)
def text_typed(spark, sf_dir):
    """Delimited text under a schema: cells that do not fit their type are NULL."""
    from fieldstar.sources.text import read_text_table

    path = staging_path(spark, "typed")
    price = F.when(F.col("o_orderkey") % 7 == 0, "dear").otherwise(F.col("o_totalprice").cast("double").cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"), F.to_date("o_orderdate").alias("day"))
    rows.write.option("header", True).csv(path)
    found = read_text_table(spark, path, schema=T.StructType.fromDDL("o_orderkey long, price double, day date"))
    return found.select("o_orderkey", "price", F.col("day").isNotNull().alias("dated"))


@query(
    "taxon_json_changes",
    """select min(p_partkey) as taxon_id, arg_max(p_brand, row(p_size, p_partkey)) as brand,
      arg_max(p_type, row(p_size, p_partkey)) as kind, 1 as kept from {part} group by p_name""",
)
def taxon_json_changes_query(spark, sf_dir):
    """A source's fields merged into known taxa: one to many names, the last row wins."""
    from fieldstar.functions.jsonblob import json_get
    from fieldstar.plans.common import taxon_json_changes

    part = table(spark, sf_dir, "part")
    taxa = part.groupBy(F.col("p_name").alias("sci_name")).agg(F.min("p_partkey").alias("taxon_id"))
    taxa = taxa.withColumn("taxon_json", F.lit('{"kept":1,"BRAND":"old"}'))
    named = part.select(
        F.col("p_name").alias("sci_name"), F.col("p_brand").alias("BRAND"), F.col("p_type").alias("KIND"), "p_size", "p_partkey"
    )
    changes = taxon_json_changes(taxa, named, "BRAND KIND", ["p_size", "p_partkey"])
    get = lambda key: json_get(F.col("taxon_json"), key)
    return changes.select(
        "taxon_id", get("BRAND").alias("brand"), get("KIND").alias("kind"), get("kept").cast("int").alias("kept")
    )


@query(
    "code_bridge_ties",
    """select cast(p_partkey % 40 as varchar) as species_id, arg_max(p_partkey, (p_size, p_partkey)) as taxon_id
    from {part} group by 1""",
)
def code_bridge_ties(spark, sf_dir):
    """Codes that a list gives many times: the last one in list order holds, not the largest id."""
    from fieldstar.operators.joins import code_bridge

    part = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("sci_name")
    codes = part.select(name, (F.col("p_partkey") % 40).cast("string").alias("species_id"), "p_size", "p_partkey")
    taxa = part.select(name, F.col("p_partkey").alias("taxon_id"))
    return code_bridge(codes, taxa, width=1, order=["p_size", "p_partkey"])
