"""Names, keys and quoting (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"  # Unicode blanks too: Latin-1 sources carry no-break spaces


def squeeze_ws(c: Column) -> Column:
    """Collapse runs of white space to one blank and trim both ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def genus_of(c: Column) -> Column:
    """First word of a scientific name; NULL when there is none."""
    return F.nullif(F.substring_index(squeeze_ws(c), " ", 1), F.lit(""))


def tight_slash(c: Column) -> Column:
    """Remove blanks around slashes."""
    return F.regexp_replace(c, r"(?U)\s*/\s*", "/")


def join_name(*parts: Column) -> Column:
    """Concatenate name parts with a blank; NULL if any part is NULL."""
    return F.concat(*[p if i == 0 else F.concat(F.lit(" "), p) for i, p in enumerate(parts)])


def tagged_key(tag: str, c: Column) -> Column:
    """Report key such as 'aou = 1234'."""
    return F.concat(F.lit(f"{tag} = "), c.cast("string"))


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros, never cutting longer text (plain lpad would)."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def prefix(c: Column, n: int) -> Column:
    """First n characters."""
    return F.substring(c, 1, n)


def before(c: Column, separator: str) -> Column:
    """Text before the first separator, or all of it."""
    return F.substring_index(c, separator, 1)


def escape_quotes(c: Column) -> Column:
    """Double every single quote."""
    return F.replace(c, F.lit("'"), F.lit("''"))


def present(c: Column) -> Column:
    """Neither NULL nor the empty string."""
    return c.isNotNull() & (c.cast("string") != "")
