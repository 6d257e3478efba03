"""Ingest datasets into a warehouse, taxonomy first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import DATASETS
from fieldstar.operators.constraints import split_by_rules, split_orphans
from fieldstar.plans.arthropods import arthropods
from fieldstar.plans.band_records import band_records
from fieldstar.plans.banding_stations import banding_stations
from fieldstar.plans.checklists import checklists
from fieldstar.plans.common import Rows
from fieldstar.plans.exchange import geo_enrich
from fieldstar.plans.july_counts import july_counts
from fieldstar.plans.nest_attempts import nest_attempts
from fieldstar.plans.survey_routes import survey_routes
from fieldstar.plans.taxonomy import base_taxonomy
from fieldstar.plans.transects import transects
from fieldstar.schema import SPLIT_TABLES, conform
from fieldstar.session import file_states, released_staging, stage
from fieldstar.sinks.tables import Warehouse, back_filled

# Order matters: later datasets look up the taxa of earlier ones. The arthropod
# surveys run only when asked for by name.
PLANS: dict[str, Callable[..., Rows]] = {
    "clements": base_taxonomy,
    "bbs": survey_routes,
    "maps": banding_stations,
    "nestwatch": nest_attempts,
    "pollard": transects,
    "naba": july_counts,
    "bbl": band_records,
    "ebird": checklists,
}
OPTIONAL = {"caterpillar": arthropods}


def reject_rows(rejected: DataFrame, table: str) -> DataFrame:
    """Rows with a reason in the shape of the rejects table."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rejected.columns if c not in ("reason", "geopoint")]))
    return rejected.select(F.lit(table).alias("table"), "reason", row.alias("row"))


def ruled(rows: Rows) -> tuple[Rows, DataFrame | None]:
    """Staged rows by table that keep the declared rules, and those that do not.

    A row without a required value is rejected, and so is one whose place or
    event was.
    """
    kept, rejected, lost = {}, [], {}
    for table in SPLIT_TABLES:
        if table not in rows:
            continue
        good, bad = split_by_rules(stage(rows[table], table), table)
        rejected.append(reject_rows(bad, table))
        lost[table] = bad
        for parent, column in (("places", "place_id"), ("events", "event_id")):
            if parent in lost and parent != table and column in good.columns and not lost[parent].isEmpty():
                good, orphans = split_orphans(good, table, lost[parent], column, parent)
                rejected.append(reject_rows(orphans, table))
                lost[table] = lost[table].unionByName(orphans)
        kept[table] = good
    if "rejects" in rows:
        rejected.append(reject_rows(split_by_rules(rows["rejects"], "counts")[1], "counts"))
    return kept, reduce(DataFrame.unionByName, rejected) if rejected else None


def fingerprint(raw: Mapping[str, DataFrame], before: str = "", options: object = "") -> str:
    """What a run's input is known by again: its frames, its options, and what ran before it.

    Frames that read files are known by their plan and by the files' paths,
    lengths and times of change, which takes no pass over the data; other
    frames by a hash over their rows, in any order.
    """
    known = hashlib.sha256(f"{before}|{options!r}".encode())
    for name, df in sorted(raw.items()):
        files = df.inputFiles()
        if files:
            plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
            content = (plan, sorted(file_states(df.sparkSession, files)))
        else:
            row = F.xxhash64(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
            content = tuple(df.agg(F.count("*"), F.bit_xor(row), F.sum(row % (1 << 31))).first())
        known.update(f"|{name}|{df.schema.simpleString()}|{content!r}".encode())
    return known.hexdigest()


def ingest(
    spark: SparkSession,
    warehouse: Warehouse,
    name: str,
    raw: Mapping[str, DataFrame],
    known_by: str | None = None,
    **options,
) -> Rows:
    """Replace one dataset's rows, extend the taxonomy, register the dataset.

    The plan is worked out against the tables without this dataset. Its rows,
    the taxonomy with its new and changed names, the registry's row, the rejects
    (rows that the declared rules forbid) and the ledger's row are written
    beside the tables and take their place in one commit: whatever fails before
    it, the old rows stay. What was staged is removed at the end. Returns the
    dataset's stored rows.
    """
    plan = {**PLANS, **OPTIONAL}[name]
    others = F.col("dataset_id") != name
    warehouse.recover()
    with released_staging(spark):
        tables = {t: df.filter(others) if t in SPLIT_TABLES else df for t, df in warehouse.tables().items()}
        rows = plan(spark, raw, tables, **options)
        changes = {c: stage(rows[f"taxon_{c}"], c) for c in ("json", "spec") if f"taxon_{c}" in rows}
        taxa = tables["taxa"]
        if "taxa" in rows:
            taxa = taxa.unionByName(conform(stage(rows["taxa"], "taxa"), "taxa"))
        for kind, frame in changes.items():
            taxa = back_filled(taxa, frame, "taxon_id", "taxon_json" if kind == "json" else kind)
        kept, rejected = ruled(rows)
        if "places" in kept:
            kept["places"] = geo_enrich(kept["places"])
        slices = {**kept, "datasets": warehouse.registry_row(DATASETS[name])}
        if rejected is not None:
            slices["rejects"] = rejected
        if known_by is not None:
            slices["runs"] = spark.range(1).select(F.lit(known_by).alias("fingerprint"), F.current_timestamp().alias("finished"))
        warehouse.commit(name, slices, {"taxa": taxa} if "taxa" in rows or changes else {})
    return stored_rows(warehouse, name, kept)


def stored_rows(warehouse: Warehouse, name: str, tables: Iterable[str] = SPLIT_TABLES) -> Rows:
    """A dataset's rows in the warehouse, and its rejects."""
    own = F.col("dataset_id") == name
    return {t: warehouse.load(t).filter(own) for t in tables} | {"rejects": warehouse.rejects().filter(own)}


def run_all(
    spark: SparkSession,
    warehouse: Warehouse,
    sources: Mapping[str, Mapping[str, DataFrame]],
    datasets: Iterable[str] | None = None,
    as_of_year: int | None = None,
    resume: bool = False,
    **options,
) -> dict[str, Rows]:
    """Ingest the wanted datasets (default: all given ones) in the fixed order.

    Every dataset that ends leaves a row in the ledger, in the same commit as
    its rows. With `resume`, a dataset is not run again whose own input, options
    and whole line of predecessors the ledger knows: a run that was killed goes
    on after the last dataset it ended, and a change runs again what it changes
    and all that comes after it, since later datasets look up earlier ones' taxa.
    """
    wanted = set(datasets or [*PLANS]) & set(sources)
    if "nestwatch" in wanted and as_of_year is None:
        raise ValueError("nest attempts need as_of_year: years after it belong to the century before")
    warehouse.recover()
    ended = {r["dataset_id"]: r["fingerprint"] for r in warehouse.runs().collect()}
    done, before = {}, ""
    for name in [*PLANS, *OPTIONAL]:
        if name not in wanted:
            continue
        extra = {**options, "as_of_year": as_of_year} if name == "nestwatch" else options
        before = fingerprint(sources[name], before, sorted(extra.items()))
        if resume and ended.get(name) == before:
            done[name] = stored_rows(warehouse, name)
        else:
            done[name] = ingest(spark, warehouse, name, sources[name], before, **extra)
    return done
