"""Rows out of HTML markup, over a table of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.functions.text import squeeze_ws

TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
LIST_ITEM = r"(?is)<li\b[^>]*>(.*?)</li\s*>"
CELL = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"

# The character references that occur in such tables.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def strip_tags(c: Column) -> Column:
    """Plain text of a markup fragment; NULL when nothing is left."""
    text = F.regexp_replace(c, "(?s)<[^>]*>", "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.nullif(squeeze_ws(text), F.lit(""))


def html_rows(
    df: DataFrame, html: str, cells: Sequence[str], row_regex: str = TABLE_ROW, cell_regex: str | None = CELL
) -> DataFrame:
    """One output row per markup row: the other columns, `row` (0, 1, ...) and the cells.

    Without a cell pattern the whole row is the single cell. Absent cells are NULL.
    """
    others = [c for c in df.columns if c != html]
    found = F.regexp_extract_all(F.col(html), F.lit(row_regex), 1)
    rows = df.select(*others, F.posexplode(found).alias("row", "_markup"))
    if cell_regex is None:
        return rows.withColumn(cells[0], strip_tags(F.col("_markup"))).drop("_markup")
    rows = rows.withColumn("_cells", F.regexp_extract_all("_markup", F.lit(cell_regex), 1))
    values = {name: strip_tags(F.get("_cells", F.lit(i))) for i, name in enumerate(cells)}
    return rows.withColumns(values).drop("_markup", "_cells")
