"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share the words of the whole table by weight, none above `max_epochs`
times its own words; what a capped source cannot take is shared again by
weight among the others. Each source takes complete epochs first and fills
the rest by weighted sampling without replacement: every document draws the
exponential key -ln(u) / quality, documents are sorted by it within their
source, and the prefix whose words fit the rest of the budget is taken. More
prefixes follow, each over the documents left that still fit what is left, until
none does: the same documents as if each in its turn was taken that still fits.

Plan at scale: the text is read once, for its word counts; rows of five small
columns are written and all else works on those. The sort within a source is a
range partitioning on (source, key), so a source with a third of all rows
spreads over as many tasks as its size asks for; the running sum of a partition
is shifted by the sums of the source's partitions before it. Draws hash the id,
so that reruns agree. Only per-source figures (one row per source) meet in one
task. All of it is built-in functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstar.llm.common import WORD, query, table
from fieldstar.session import stage

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
PENALTY = 20.0


def symbol_quality(text: Column) -> Column:
    """A document weight in (0, 1]: the lower, the more of the text is symbols."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>!", ""))
    return F.lit(1.0) / (1.0 + PENALTY * symbols / F.greatest(F.length(text), F.lit(1)))


def _draw(id_col: str, seed: str) -> Column:
    """A uniform number in (0, 1) from a row's id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add _s (place by code point, NULL last), and `target` to one row per source (_source, source_size).

    With sources by cap over weight, those before the first one whose fair
    share is below its cap are exactly the capped ones.
    """
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_s") % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("_s", place).withColumn("_w", weight.cast("long"))
    ranked = ranked.withColumn("_ratio", F.lit(float(max_epochs)) * F.col("source_size") / F.col("_w"))
    order = Window.orderBy("_ratio", "_s")
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("source_size").over(every) - max_epochs * capped
    heavy = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = ranked.withColumns({"_rest": rest, "_heavy": heavy, "_rank": F.row_number().over(order)})
    below = F.col("_rest") / F.col("_heavy") <= F.col("_ratio")
    ranked = ranked.withColumn("_first", F.min(F.when(below, F.col("_rank"))).over(every))
    at_first = lambda c: F.max(F.when(F.col("_rank") == F.col("_first"), F.col(c))).over(every)
    ranked = ranked.withColumns({"_t": at_first("_rest"), "_v": at_first("_heavy")})
    share = (F.col("_w") * F.col("_t")).cast("double") / F.col("_v")
    target = F.when(F.col("_rank") < F.col("_first"), F.lit(float(max_epochs)) * F.col("source_size")).otherwise(share)
    return ranked.select("_source", "_s", "source_size", target.alias("target"))


def _prefix(placed: DataFrame, size: str) -> Column:
    """Running sum of a size within a source, inclusive, from staged range partitions."""
    totals = placed.groupBy("_s", "_part").agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy("_s").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_s", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_s", "_part").orderBy("_key", "_id", "size")
    running = F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("_inside", running).join(totals, ["_s", "_part"]).withColumn(
        "_run", F.col("_before") + F.col("_inside")
    ).drop("_before", "_inside")


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality=symbol_quality,
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, copies and taken (size times copies).

    A NULL text has no words. A NULL source is a source of its own, the last.
    Rows of equal key are taken in the order of id and size; rows that repeat
    both are alike, so either choice gives the same result. No document has
    more than `max_epochs` copies; one without words has those of the complete
    epochs. A source without words takes nothing. No document that is left out
    of the last, partial epoch would fit what its source's target still lacks.
    An empty table gives no row. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(_draw(id_col, seed)) / quality(text)).alias("_key"),
    )
    rows = stage(rows, "mix-sizes")
    sources = source_targets(rows.groupBy("_source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    sources = sources.withColumn("_epochs", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
    budget = F.floor(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long")
    sources = sources.withColumn("_rest", budget)
    met = rows.join(
        sources.withColumnRenamed("_source", "_from"), F.col("_source").eqNullSafe(F.col("_from"))
    ).drop("_source", "_from")
    order = ["_s", "_key", "_id", "size"]
    ranged = met.repartitionByRange(*order).sortWithinPartitions(*order)
    left = stage(ranged.withColumn("_part", F.spark_partition_id()), "mix-order")

    done = []
    while True:
        fits = (F.col("size") > 0) & (F.col("size") <= F.col("_rest"))
        done.append(left.filter(~fits).withColumn("copies", F.col("_epochs")))
        open_ = left.filter(fits)
        if done[1:] and open_.isEmpty():
            break
        swept = _prefix(open_, "size").withColumn("_in", F.col("_run") <= F.col("_rest")).drop("_run")
        swept = stage(swept, "mix-sweep")
        done.append(swept.filter("_in").withColumn("copies", F.col("_epochs") + 1))
        # What is spent reaches the rows by partition, not by source: a join on the source would gather a hot one.
        spent = swept.filter("_in").groupBy("_s").agg(F.sum("size").alias("_spent"))
        spent = swept.select("_s", "_part").distinct().join(spent, "_s", "left")
        left = swept.filter("not _in").drop("_in").join(spent, ["_s", "_part"])
        left = left.withColumn("_rest", F.col("_rest") - F.coalesce("_spent", F.lit(0))).drop("_spent")
        left = stage(left, "mix-left")
    columns = ["_id", "size", "source_size", "target", "copies"]
    every = reduce(DataFrame.unionByName, [d.select(*columns) for d in done])
    return every.select(
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def copies_to_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the frame, each as often as `mix_sources` takes it, with all their columns.

    Rows that repeat an id share out its copies: the mix may take some of them
    more often than others, and takes them in the order of their columns.
    """
    taken = mix_sources(df, id_col, text_col, **options)
    per_id = taken.groupBy(F.col(id_col).alias("_of")).agg(
        F.sum("copies").alias("_sum"), F.count("*").alias("_rows"), F.max("copies").alias("_copies")
    )
    per_id = stage(per_id.filter("_sum > 0"), "mix-copies")
    rows = df.select(F.col(id_col).alias("_id"), F.struct("*").alias("_whole"))
    met = rows.join(per_id, F.col("_id").eqNullSafe(F.col("_of")))
    # Only rows that repeat an id and are not all taken alike need an order among them.
    alike = F.col("_sum") == F.col("_rows") * F.col("_copies")
    plain = met.filter(alike).withColumn("_times", F.col("_copies"))
    place = F.row_number().over(Window.partitionBy("_of").orderBy("_whole")) - 1
    share = F.floor(F.col("_sum") / F.col("_rows"))
    more = F.when(place < F.col("_sum") - share * F.col("_rows"), 1).otherwise(0)
    both = plain.unionByName(met.filter(~alike).withColumn("_times", share + more)).filter("_times > 0")
    again = both.select("_whole", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return again.select("_whole.*")


@query(
    "op10_source_mixing",
    rf"""
    WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
    z AS (SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
                 -ln((('0x' || substr(md5('{SEED}:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
                 / (1.0 / (1.0 + {PENALTY}::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>!', '')))
                           / greatest(length(t), 1))) AS k FROM d),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s
          FROM z GROUP BY source),
    w AS (SELECT *, s % 3 + 1 AS w, {MAX_EPOCHS}::DOUBLE * source_size / (s % 3 + 1) AS ratio FROM s),
    o AS (SELECT *, row_number() OVER (ORDER BY ratio, s) AS rank,
                 (sum(source_size) OVER () - {MAX_EPOCHS} * coalesce(sum(source_size) OVER
                    (ORDER BY ratio, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
                 (sum(w) OVER (ORDER BY ratio, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS heavy
          FROM w),
    f AS (SELECT rank AS first, rest AS t, heavy AS v FROM o WHERE rest::DOUBLE / heavy <= ratio ORDER BY rank LIMIT 1),
    g AS (SELECT o.source, source_size,
                 CASE WHEN rank < first THEN {MAX_EPOCHS}::DOUBLE * source_size ELSE (w * t)::DOUBLE / v END AS target
          FROM o, f),
    e AS (SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS epochs FROM g),
    b AS (SELECT row_number() OVER () AS r, z.doc_id, z.size, z.k, e.*,
                 floor(target - epochs * source_size)::BIGINT AS budget
          FROM z JOIN e ON z.source IS NOT DISTINCT FROM e.source),
    n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id, size) AS turn FROM b WHERE size > 0),
    turns AS (
        SELECT DISTINCT source, 0 AS turn, budget AS rest, 0 AS r, FALSE AS taken FROM n
        UNION ALL
        SELECT n.source, n.turn, CASE WHEN n.size <= rest THEN rest - n.size ELSE rest END, n.r, n.size <= rest
        FROM turns AS t JOIN n ON n.source IS NOT DISTINCT FROM t.source AND n.turn = t.turn + 1),
    c AS (SELECT b.*, epochs + CASE WHEN t.taken THEN 1 ELSE 0 END AS copies FROM b LEFT JOIN turns AS t ON t.r = b.r)
    SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM c
    """,
)
def op10_source_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))
