"""CSV exports, imports and reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.operators.textrepair import header_names, parsed_records, quoted_lines, typed_records, width_faults
from fieldstar.schema import SCHEMAS, SPLIT_TABLES
from fieldstar.session import stage
from fieldstar.sources.text import read_lines

FAULT_COLUMNS = ("record", "first_line", "fields", "text")

# Lines per exported piece of the two large tables.
PIECE_LINES = {"counts": 10_000_000, "events": 5_000_000}

# NULL is written as nothing and '' as "", and read back the same way; text
# quotes are doubled and blanks kept.
_WRITE = {"escape": '"', "nullValue": "", "emptyValue": '""'}
_READ = {"escape": '"', "nullValue": "\u0001", "emptyValue": "", "multiLine": "true"}
_BOTH = {"header": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _exportable(df: DataFrame) -> DataFrame:
    binary = {c: F.base64(F.col(c)) for c, t in df.dtypes if t == "binary"}
    return df.withColumns(binary) if binary else df


def export_csv(tables: Mapping[str, DataFrame], item: str, path: str) -> list[str]:
    """Write a whole table, or one dataset's slice of the split tables, without header.

    Returns the folders written: <path>/<table>.csv, or <path>/<table>_<item>.csv.
    """
    if item in SCHEMAS:
        written = {f"{path}/{item}.csv": (item, tables[item])}
    else:
        written = {
            f"{path}/{t}_{item}.csv": (t, tables[t].filter(F.col("dataset_id") == item)) for t in SPLIT_TABLES
        }
    for folder, (table, df) in written.items():
        writer = _exportable(df).write.mode("overwrite").options(**_WRITE, **_BOTH)
        writer.option("maxRecordsPerFile", PIECE_LINES.get(table, 0)).csv(folder)
    return list(written)


def import_tables(spark: SparkSession, path: str, pieces: Mapping[str, Iterable[str]] | None = None) -> dict[str, DataFrame]:
    """Read exported CSV back by position into the tables' fixed schemas.

    `pieces` names the folders of each table below `path`; by default one
    folder per table, named after it. Cells may hold line breaks: files are
    read as numbered lines, split by split, and each record is parsed by
    itself, so one large file is imported by many tasks. A record that does
    not have the table's columns raises.
    """
    pieces = pieces or {t: [f"{t}.csv"] for t in SCHEMAS}
    return {t: _imported(spark, [f"{path}/{f}" for f in folders], t) for t, folders in pieces.items()}


def _imported(spark: SparkSession, folders: list[str], table: str) -> DataFrame:
    fields = SCHEMAS[table].fields
    lines = stage(quoted_lines(read_lines(spark, folders, "UTF-8", "\n")), "import")
    faults = width_faults(lines, len(fields)).limit(3).collect()
    if faults:
        raise ValueError(f"{table}: records of another width, such as {[(f['file'], f['first_line'] + 1) for f in faults]}")
    binary = [f.name for f in fields if f.dataType.simpleString() == "binary"]
    ddl = ", ".join(f"`{f.name}` {'string' if f.name in binary else f.dataType.simpleString()}" for f in fields)
    df = typed_records(lines, ddl, len(fields), {**_READ, **_BOTH}).drop("file", "record")
    return df.withColumns({c: F.unbase64(F.col(c)) for c in binary}) if binary else df


def write_uniform(df: DataFrame, path: str) -> None:
    """Write CSV with a header under the one dialect; blanks at the edges of cells are kept."""
    df.write.mode("overwrite").options(**{**_BOTH, "header": "true"}, escape='"').csv(path)


def write_report(df: DataFrame | Iterable[DataFrame], path: str) -> None:
    """Write one or several like-shaped frames as one CSV report with a header."""
    frames = [df] if isinstance(df, DataFrame) else list(df)
    stacked = reduce(DataFrame.unionByName, frames)
    write_uniform(stacked, path)


def normalise_dialect(
    spark: SparkSession, specs: Mapping[str, str], source: str, target: str, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Re-write delimited files with their own quote character under one dialect.

    `specs` maps file name to quote character. Records are put together from
    numbered lines and parsed one by one, so cells may span lines and the
    result does not depend on how many tasks or part files a file takes. The
    first record of a file names its columns. Returns the records of another
    width (table, record, first_line, fields, text), which are not written.
    """
    faults = []
    for name, quote in specs.items():
        lines = stage(quoted_lines(read_lines(spark, f"{source}/{name}", encoding), quote), "dialect")
        names = header_names(lines, quote)
        if not names:
            raise ValueError(f"{source}/{name} has no header")
        body = parsed_records(lines, names, quote).filter("record > 1").drop("file", "record")
        write_uniform(body, f"{target}/{name}")
        faults.append(width_faults(lines, len(names)).select(F.lit(name).alias("table"), *FAULT_COLUMNS))
    return reduce(DataFrame.unionByName, faults)
