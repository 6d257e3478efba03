"""Card files of an older programme: repair, check, re-write, describe."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.formats import CARD_FILES, METADATA_COLUMNS
from fieldstar.operators.textrepair import card_lines, header_names, parsed_records, quoted_lines, width_faults
from fieldstar.session import stage
from fieldstar.sinks.files import FAULT_COLUMNS, write_uniform
from fieldstar.sources.text import read_lines

SINGLE = "'"


def card_file_lines(spark: SparkSession, source: str, name: str, quote: str, cols: int) -> DataFrame:
    """One file's lines with their records, repaired if single-quoted, written once."""
    lines = read_lines(spark, f"{source}/{name}.txt")
    return stage(card_lines(lines, cols) if quote == SINGLE else quoted_lines(lines, quote), name)


def repair_files(spark: SparkSession, source: str, target: str, specs: Mapping[str, tuple[str, int]] = CARD_FILES) -> None:
    """Write every file's lines below `target`, single-quoted ones repaired.

    Output keeps the line order: range-partitioned by line number, one
    folder per file.
    """
    for name, (quote, cols) in specs.items():
        lines = card_file_lines(spark, source, name, quote, cols)
        ordered = lines.repartitionByRange("line_no").sortWithinPartitions("line_no")
        ordered.select("text").write.mode("overwrite").text(f"{target}/{name}.csv")


def check_files(spark: SparkSession, path: str, specs: Mapping[str, tuple[str, int]] = CARD_FILES) -> DataFrame:
    """Records of all files whose field count is not the declared one, with their first line.

    Cells may span lines, under either quote. All faults are reported, not
    only the first.
    """
    return reduce(
        DataFrame.unionByName,
        [
            _faults(card_file_lines(spark, path, name, quote, cols), name, cols)
            for name, (quote, cols) in specs.items()
        ],
    )


def _faults(lines: DataFrame, name: str, cols: int) -> DataFrame:
    return width_faults(lines, cols).select(F.lit(name).alias("table"), *FAULT_COLUMNS)


def table_metadata(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and one per column, with blank key columns to fill in."""
    spark = next(iter(tables.values())).sparkSession
    names = METADATA_COLUMNS.split()
    rows = []
    for table, df in tables.items():
        rows.append((table, "", "", "", "", ""))
        rows += [(table, column, None, None, None, None) for column in df.columns]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


def card_files(
    spark: SparkSession, source: str, target: str, specs: Mapping[str, tuple[str, int]] = CARD_FILES
) -> dict[str, DataFrame]:
    """Repair, check and re-write all card files below `target`/uniform; returns `faults` and `metadata`.

    Cells are parsed from the numbered records themselves: the first record of
    a file is its header, however the file is split over tasks.
    """
    faults, uniform = [], {}
    for name, (quote, cols) in specs.items():
        lines = card_file_lines(spark, source, name, quote, cols)
        faults.append(_faults(lines, name, cols))
        names = header_names(lines, quote)
        if len(names) != cols:
            raise ValueError(f"{name}: the header has {len(names)} columns, {cols} are declared")
        cells = parsed_records(lines, names, quote).filter("record > 1").drop("file", "record")
        write_uniform(cells, f"{target}/uniform/{name}.csv")
        uniform[name] = cells
    return {"faults": reduce(DataFrame.unionByName, faults), "metadata": table_metadata(uniform)}
