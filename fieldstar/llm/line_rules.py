"""Quality rules: line frequency across documents, beside rules on each document.

Lines are normalised (lower case, single spaces, trimmed) and hashed. A line
that more than `max_share` of a host's documents carry (and more than
`min_docs` of them) is boilerplate; a document that keeps less than
`least_left` of its words without boilerplate is depleted and rejected.

Plan at scale: one pass over the text computes every per-document figure and a
compact list of (hash, words) per line, and is written once; everything after
it moves hashes only. Documents are made distinct per (host, line) before they
are counted, so a line that a third of all documents carry is counted in
pieces. Repeated word windows are found inside a row by sorting its windows.
All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import WORD, bind, query, table
from fieldstar.llm.line_dedup import kept_text
from fieldstar.session import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_SHARE = 0.01
MIN_DOCS = 5
LEAST_LEFT = 0.5


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that occurs twice or more (`words`: a bound array)."""

    def at(i):
        return F.get(words, i)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.concat_ws(" ", at(i), at(i + 1), at(i + 2)).alias("t"), i.alias("p")),
    )

    def covered(ordered):
        same = lambda x, k: (F.get(ordered, k - 1)["t"] == x["t"]) | (F.get(ordered, k + 1)["t"] == x["t"])
        twice = F.filter(ordered, lambda x, k: F.coalesce(same(x, k), F.lit(False)))
        places = F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    # Windows whose hashes all differ are different; only other texts need their windows sorted.
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    return (
        F.when(F.size(words) < 4, 0)
        .when(F.size(F.array_distinct(hashes)) == F.size(words) - 2, 0)
        .otherwise(bind(F.array_sort(windows), covered))
    )


def _has_words(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def normal(line: Column) -> Column:
    """Lower case, single spaces, none at the ends; a single space stays as it is, so that most lines need no change."""
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")))


def _words_of(normal_line: Column) -> Column:
    return F.size(F.split(normal_line, " ", -1)).cast("long")


def _common(lines: DataFrame, docs: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(_in, _hash): lines that too many of a host's documents carry; lines by _host, _h, _id, documents by _host, _id."""
    hosts = docs.groupBy("_host").agg(F.count_distinct(F.struct("_id")).alias("_docs"))
    hosts = stage(hosts.withColumnRenamed("_host", "_at"), "line-hosts")  # so that the join can split a hot host
    carried = lines.select("_host", "_h", "_id").distinct().groupBy("_host", "_h").count()
    common = carried.filter(F.col("count") > min_docs).join(hosts, F.col("_host").eqNullSafe(F.col("_at")))
    common = common.filter(F.col("count") > F.col("_docs") * max_share)
    return common.select(F.col("_host").alias("_in"), F.col("_h").alias("_hash"))


def remove_common_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """The rows of the frame, all columns as they are but the text, which loses the lines above its host's limit.

    These are the lines whose words `quality_rules` counts as removed: a NULL
    text stays NULL, lines without words stay, and the other lines keep their
    order and line breaks. Rows that repeat id, host and text come out alike.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = (F.xxhash64(F.col(id_col), F.col(host_col), text), F.xxhash64(F.lit("second"), F.col(host_col), F.col(id_col), text))
    hashed = F.transform(
        F.split(text, "\n", -1),
        lambda x, i: F.when(_has_words(x), F.struct(i.alias("_p"), F.xxhash64(normal(x)).alias("_h"))),
    )
    docs = stage(
        df.select(
            names[0].alias("_a"), names[1].alias("_b"), F.col(id_col).alias("_id"), F.col(host_col).alias("_host"),
            F.filter(hashed, lambda x: x.isNotNull()).alias("_lines"),
        ),
        "line-places",
    )
    lines = docs.select("_a", "_b", "_id", "_host", F.inline("_lines"))
    common = _common(lines, docs, min_docs, max_share)
    met = lines.join(common, (F.col("_h") == F.col("_hash")) & F.col("_host").eqNullSafe(F.col("_in")), "left_semi")
    lost = met.groupBy("_a", "_b").agg(F.sort_array(F.collect_set("_p")).alias("_lost"))
    lost = stage(lost, "lines-to-remove")
    whole = df.select(names[0].alias("_a"), names[1].alias("_b"), text.alias("_text"), F.struct("*").alias("_row"))
    joined = whole.join(lost, ["_a", "_b"], "left").withColumn("_lost", F.coalesce("_lost", F.array().cast("array<int>")))
    left = F.when(F.col(f"_row.`{text_col}`").isNotNull(), kept_text(F.col("_text"), F.col("_lost")))
    return joined.select(*[left.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def _figures(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    of_words = bind(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            repeated_words(w).cast("long").alias("twice"),
        ),
    )
    lines = F.filter(F.split(text, "\n", -1), _has_words)
    of_lines = bind(
        lines,
        lambda ls: F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("again"),
            F.transform(
                ls,
                lambda x: bind(normal(x), lambda y: F.struct(F.xxhash64(y).alias("h"), _words_of(y).alias("w"))),
            ).alias("all"),
        ),
    )
    found = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(host_col).alias("_host"),
        of_words.alias("_w"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        of_lines.alias("_l"),
    )
    return found.select(
        "_row",
        "_id",
        "_host",
        F.col("_w.n").alias("n_words"),
        F.col("_w.chars").alias("word_chars"),
        "n_symbols",
        F.col("_l.again").alias("n_dup_lines"),
        F.col("_w.twice").alias("n_repeat_words"),
        F.col("_l.all").alias("_lines"),
    )


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """One row per input row: id, the figures, removed_words, base_failed and kept.

    removed_words are those of the lines that `remove_common_lines` takes out
    of the text; a document that keeps too few of its words is not kept.

    A NULL text counts as empty; an empty text has no words and fails the base
    rules. Hosts are compared with NULL as a host of its own. Rows that repeat
    an id count as one document for line frequencies, and each gets its own
    output row. An empty table gives no row. Other columns are ignored.
    """
    docs = stage(_figures(df, id_col, text_col, host_col), "line-figures")
    lines = docs.select("_row", "_id", "_host", F.explode("_lines").alias("_line"))
    lines = lines.select("_row", "_id", "_host", F.col("_line.h").alias("_h"), F.col("_line.w").alias("_n"))

    common = _common(lines, docs, min_docs, max_share)
    met = lines.join(common, (F.col("_h") == F.col("_hash")) & F.col("_host").eqNullSafe(F.col("_in")))
    removed = met.groupBy("_row").agg(F.sum("_n").alias("removed_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    joined = docs.drop("_lines").join(removed, "_row", "left")
    joined = joined.withColumn("removed_words", F.coalesce(F.col("removed_words"), F.lit(0).cast("long")))
    depleted = F.col("n_words") - F.col("removed_words") < least_left * F.col("n_words")
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "removed_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )


@query(
    "op9_quality_rules",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
    ws AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS p
           FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d)),
    tri AS (SELECT r, p, w || ' ' || lead(w) OVER s || ' ' || lead(w, 2) OVER s AS g
            FROM ws WINDOW s AS (PARTITION BY r ORDER BY p)),
    twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM tri WHERE g IS NOT NULL)
              WHERE c > 1),
    covered AS (SELECT r, count(DISTINCT p + k) AS n FROM twice, (VALUES (0), (1), (2)) AS x(k) GROUP BY r),
    words AS (SELECT r, count(*) AS n FROM ws GROUP BY r),
    ln AS (SELECT r, doc_id, source, l, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
           FROM (SELECT r, doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d)
           WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM ln GROUP BY r),
    host AS (SELECT source, count(DISTINCT doc_id) AS docs FROM d GROUP BY source),
    common AS (SELECT f.source, f.norm FROM (SELECT source, norm, count(DISTINCT doc_id) AS c FROM ln GROUP BY ALL) AS f
               JOIN host AS h ON f.source IS NOT DISTINCT FROM h.source
               WHERE c > {MIN_DOCS} AND c > h.docs * {MAX_SHARE}),
    gone AS (SELECT r, sum(len(string_split(ln.norm, ' ')))::BIGINT AS n FROM ln
             JOIN common AS c ON ln.norm = c.norm AND ln.source IS NOT DISTINCT FROM c.source GROUP BY r),
    f AS (SELECT doc_id, coalesce(words.n, 0) AS n_words,
                 length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
                 coalesce(gone.n, 0) AS removed_words
          FROM d LEFT JOIN words USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r))
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
           NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
           AND NOT n_words - removed_words < {LEAST_LEFT} * n_words AS kept
    FROM f
    """,
)
def op9_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))
