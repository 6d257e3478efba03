"""Delimited text sources: everything is read as text and coerced later."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstar.operators.columns import normalize_columns
from fieldstar.operators.keys import meet_offsets
from fieldstar.session import stage


def read_text_table(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    quote: str = '"',
    encoding: str = "UTF-8",
    schema: T.StructType | None = None,
    multi_line: bool = False,
    row_order: bool = False,
    na_values: Sequence[str] = (),
    ragged: str | None = None,
) -> DataFrame:
    """Read delimited files with a header; all columns are text unless a schema is given.

    Cells that are one of `na_values` are NULL. A row with too many or too few
    cells raises; with `ragged` it is kept, its cells as far as they go and the
    whole row in a column of that name (NULL for sound rows). Under a given
    schema, cells that do not fit their type are NULL.

    quote="" keeps quote characters as data. A gzip file is one split, so
    redistribute it right after the scan (see `spread`). With `row_order` the
    columns _file, _block, _row give every row its place in the input.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote or "\\")
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("inferSchema", False)
    )
    if schema is not None:
        reader = reader.schema(schema)
    elif ragged is not None:
        # The width of a row is only checked where all its cells are parsed.
        header = reader.csv(path).schema
        reader = reader.schema(header.add(ragged, "string")).option("columnNameOfCorruptRecord", ragged)
        reader = reader.option("columnPruning", False)
    else:
        reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
    df = reader.csv(path)
    if na_values:
        text = [f.name for f in df.schema.fields if f.dataType == T.StringType() and f.name != ragged]
        df = df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*na_values), F.col(f"`{c}`")) for c in text})
    return with_row_order(df) if row_order else df


def with_row_order(df: DataFrame) -> DataFrame:
    """Add (_file, _block, _row): file, offset of the split, row within it.

    _row is only compared within one split, which one task reads front to
    back, so the order does not depend on how splits are handed out.
    """
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Redistribute input that comes in too few splits (gzip, one row group).

    It costs a shuffle of the input whatever its size: use it for files that
    Spark cannot split, with the number of tasks the work behind them asks for.
    """
    return df.repartition(partitions)


def read_many(spark: SparkSession, families: Mapping[str, str], tag: str = "TYPE", **options) -> DataFrame:
    """Read several file families by glob, tag each, and stack them.

    Families are numbered in the given order (_family), which together with
    the row order gives the processing order of the whole input.
    """
    frames = []
    for i, (kind, pattern) in enumerate(families.items()):
        df = read_text_table(spark, pattern, row_order=True, **options)
        frames.append(normalize_columns_but_order(df).withColumns({tag: F.lit(kind), "_family": F.lit(i)}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def normalize_columns_but_order(df: DataFrame) -> DataFrame:
    """Clean column names, leaving the row order columns alone."""
    order = [c for c in ("_file", "_block", "_row") if c in df.columns]
    kept = {f"order{i}": F.col(c) for i, c in enumerate(order)}
    clean = normalize_columns(df.withColumns(kept).drop(*order))
    return clean.withColumnsRenamed({f"order{i}": c for i, c in enumerate(order)})


def read_lines(
    spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1", line_sep: str | None = None
) -> DataFrame:
    """Text files as a line table (file, line_no, text), line_no counting from 0.

    Lines end at any usual line break, or at `line_sep` alone. The lines of each split are numbered where they are read and shifted by
    the sizes of the file's earlier splits, so a large file stays distributed.
    Blank lines count.
    """
    options = {"lineSep": line_sep} if line_sep else {}
    lines = with_row_order(spark.read.options(**options).text(path))
    lines = stage(lines.withColumn("text", F.decode(F.col("value").cast("binary"), encoding)).drop("value"), "lines")
    split = ["_file", "_block"]
    sizes = lines.groupBy(*split).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    number = F.col("_row") - F.col("_first") + F.col("_offset")
    return meet_offsets(lines, shifts.drop("_n"), split).select(F.col("_file").alias("file"), number.alias("line_no"), "text")
