"""Line deduplication across documents.

Lines are normalised and hashed; a line that many documents carry is dropped
everywhere but in one of them, and each text is put together again from the
lines that are left, by position.

Plan at scale:

* One pass over the text writes, per row, the hashes of its long enough lines
  by position. All later steps but the last move hashes and positions only.
* Documents per hash are counted in two steps (distinct documents first), so a
  line that a third of all documents carry is counted in pieces.
* Hashes carried by more than 1 / `HEAVY` of all places of common lines are
  found first. There are fewer than `HEAVY` of these, whatever the table, which
  bounds the only broadcast; no other hash has enough places to fill a task.
* The last pass reads the text again and meets each document's dropped
  positions, one row per document that loses a line.

A line's name is two 64-bit hashes with different seeds. Documents meet their
positions under such a name of id and text. All of it is built-in functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import SPACES, bind, query, table
from fieldstar.session import stage

MIN_CHARS = 40
MIN_DOCS = 5
HEAVY = 2000


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, with A-Z in lower case."""

    def low(key):
        # Lower case of plain ASCII is the same and much cheaper than looking each letter up.
        plain = F.octet_length(key) == F.length(key)
        ascii_low = F.translate(key, string.ascii_uppercase, string.ascii_lowercase)
        return F.when(plain, F.lower(key)).otherwise(ascii_low)

    return bind(F.btrim(line, F.lit(SPACES)), low)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _names(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def _hashed(df: DataFrame, id_col: str, text: Column, min_chars: int) -> DataFrame:
    """(_a, _b, _id, _p, _x, _y) for each line that is long enough: document, position, hash of its key."""

    def named(line, position):
        def hashes(key):
            x, y = _names(key)
            return F.when(F.length(key) >= min_chars, F.struct(position.alias("_p"), x.alias("_x"), y.alias("_y")))

        return bind(line_key(line), hashes)

    a, b = _names(F.col(id_col), text)
    found = F.filter(F.transform(_lines(text), named), lambda x: x.isNotNull())
    docs = df.select(a.alias("_a"), b.alias("_b"), F.col(id_col).alias("_id"), found.alias("_lines"))
    rows = stage(docs.filter(F.size("_lines") > 0), "line-hashes")
    return rows.select("_a", "_b", "_id", F.inline("_lines"))


def _dropped(places: DataFrame, common: DataFrame) -> DataFrame:
    """(_a, _b, _p) of the places whose line is common and kept in another document."""
    total = common.agg(F.sum("_places")).first()[0] or 0
    heavy = common.filter(F.col("_places") * HEAVY > total)
    other = common.filter(F.col("_places") * HEAVY <= total)
    same = ["_x", "_y"]
    by_broadcast = places.join(F.broadcast(heavy), same)
    by_shuffle = places.join(F.broadcast(heavy), same, "left_anti").join(other, same)
    met = by_broadcast.unionByName(by_shuffle)
    return met.filter(~F.col("_id").eqNullSafe(F.col("_keeper"))).select("_a", "_b", "_p")


def kept_text(text: Column, positions: Column) -> Column:
    """The text without the lines at the given ascending positions (0-based)."""

    def rebuilt(gone):
        before = lambda k: F.when(k == 0, -1).otherwise(F.element_at(gone, k))
        runs = F.transform(
            gone, lambda p, k: F.concat(F.array_repeat(F.lit(True), p - before(k) - 1), F.array(F.lit(False)))
        )
        keep = lambda stays: F.filter(_lines(text), lambda _, i: F.coalesce(F.get(stays, i), F.lit(True)))
        return F.array_join(bind(F.flatten(runs), keep), "\n")

    return F.when(F.size(positions) == 0, text).otherwise(bind(positions, rebuilt))


def _without_common(df: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(_row, _text, n_lines, n_dropped): whole input rows with what is left of their text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    places = _hashed(df, id_col, text, min_chars)
    carried = places.groupBy("_x", "_y").agg(
        F.count_distinct(F.struct("_id")).alias("_docs"),
        F.max("_id").alias("_keeper"),
        F.count("*").alias("_places"),
    )
    # Written, so that the join does not inherit the aggregate's partitions: only then can it be split.
    common = stage(carried.filter(F.col("_docs") >= min_docs).drop("_docs"), "common-lines")
    dropped = _dropped(places, common)
    # Rows that repeat id and text have the same positions; a set holds them once.
    lost = dropped.groupBy("_a", "_b").agg(F.sort_array(F.collect_set("_p")).alias("_lost"))
    lost = stage(lost, "lost-lines")
    a, b = _names(F.col(id_col), text)
    docs = df.select(a.alias("_a"), b.alias("_b"), text.alias("_whole"), F.struct("*").alias("_row"))
    met = docs.join(lost, ["_a", "_b"], "left")
    none = F.array().cast("array<int>")
    met = met.withColumn("_lost", F.coalesce("_lost", none))
    return met.select(
        "_row",
        kept_text(F.col("_whole"), F.col("_lost")).alias("_text"),
        F.size(_lines(F.col("_whole"))).cast("long").alias("n_lines"),
        F.size("_lost").cast("long").alias("n_dropped"),
    )


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped and kept_text.

    A line's key is the line without ASCII white space at its ends and with A-Z
    in lower case. Keys of `min_chars` code points or more that `min_docs`
    documents or more hold lose all their lines, but for those in the document
    of the largest id among them: there every such line stays, also repeats.

    A NULL or empty text is one empty line. A text that loses all lines comes
    out empty. Rows that repeat an id are one document for the counting, and
    each comes out; a NULL id is one document, which any other id outranks. An
    empty table gives no row. Other columns are ignored, whatever their names.
    """
    narrow = df.select(F.col(id_col).alias("_of"), F.col(text_col).alias("_in"))
    found = _without_common(narrow, "_of", "_in", min_chars, min_docs)
    return found.select(F.col("_row._of").alias(id_col), "n_lines", "n_dropped", F.col("_text").alias("kept_text"))


def drop_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of the frame, all columns as they are but the text, which loses its common lines (NULL stays NULL)."""
    limits = {"min_chars": MIN_CHARS, "min_docs": MIN_DOCS} | options
    found = _without_common(df, id_col, text_col, **limits)
    kept = F.when(F.col(f"_row.`{text_col}`").isNotNull(), F.col("_text"))
    columns = [kept.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    return found.select(*columns)


@query(
    "op11_line_dedup",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS}
          GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
    m AS (SELECT r, doc_id, line, p, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM k LEFT JOIN c USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM m GROUP BY r, doc_id
    """,
)
def op11_line_dedup(spark, sf_dir):
    found = dedup_lines(table(spark, sf_dir, "documents"))
    sha = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", sha)
