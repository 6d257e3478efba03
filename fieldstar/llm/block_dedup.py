"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. Equal blocks get the
same integer name and different blocks different ones; then adjacent names are
paired and the pairs named, level by level, until one name stands for a whole
document. Two documents of equal name hold the same bytes: no step takes equal
hashes for equal content.

Plan at scale:

* Blocks meet under a 64-bit address. Sorting by it combines equal blocks
  before the shuffle, so each map task sends a block once, however often it
  occurs, and text crosses the network once. Where an address holds two
  different blocks (found by comparing its least and greatest content), its
  blocks are told apart by their bytes.
* Names are places in the order of (address, content), numbered without a
  single-task sort. Every level is written to the shared folder, so a lost
  executor costs one level and names never change.
* Later levels move two integers per pair and halve the rows each time.
* Sizes and keepers are plain aggregates joined back on the name; no task holds
  a group, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import bind, query, table
from fieldstar.operators.keys import assign_ids
from fieldstar.session import stage

BLOCK_BYTES = 8192
ADDRESS_BITS = 64


def _blocks(text: Column, size: int) -> Column:
    """The text's bytes as blocks; an empty text has one empty block."""
    last = lambda raw: F.ceil(F.length(raw) / F.lit(float(size))).cast("int") - 1
    cut = lambda raw: F.transform(
        F.sequence(F.lit(0), F.greatest(last(raw), F.lit(0))),
        lambda i: F.substring(raw, i * size + 1, F.lit(size)),
    )
    return bind(text.cast("binary"), cut)


def _name_blocks(blocks: DataFrame, address_bits: int) -> DataFrame:
    """Integer names by address; a row with a block names that content only."""
    contents = blocks.groupBy("_addr").agg(F.min("_block").alias("_least"), F.max("_block").alias("_most"))
    shared = F.col("_least") != F.col("_most")
    addresses = stage(contents.select("_addr", shared.alias("_shared")), "block-addresses")
    crowded = addresses.filter("_shared").select("_addr")
    single = addresses.filter("not _shared").select("_addr", F.lit(None).cast("binary").alias("_only"))
    if crowded.isEmpty():
        named = single
    else:
        told_apart = blocks.join(crowded, "_addr").select("_addr", F.col("_block").alias("_only")).distinct()
        named = single.unionByName(told_apart)
    return assign_ids(named, "_name", 1, ["_addr", "_only"])


def _name_documents(occurrences: DataFrame) -> list[DataFrame]:
    """(_id, _sha, _reps, _level, _name) in one staged frame per level of pairing.

    `occurrences` has a row per document and block: _id, _sha, _blocks, _pos, _name, _reps.
    """
    done, level = [], 0
    most = occurrences.agg(F.max("_blocks")).first()[0] or 0
    while True:
        whole = occurrences.filter("_blocks = 1").groupBy("_id", "_sha", "_name").agg(F.sum("_reps").alias("_reps"))
        done.append(whole.withColumn("_level", F.lit(level)))
        if most <= 1:
            return done
        even = F.col("_pos") % 2 == 0
        pairs = (
            occurrences.filter("_blocks > 1")
            .groupBy("_id", "_sha", "_blocks", F.floor(F.col("_pos") / 2).alias("_pos"))
            .agg(
                F.max(F.when(even, F.col("_name"))).alias("_left"),
                F.coalesce(F.max(F.when(~even, F.col("_name"))), F.lit(0)).alias("_right"),
                F.sum(F.when(even, F.col("_reps")).otherwise(0)).alias("_reps"),
            )
        )
        pairs = stage(pairs.withColumn("_blocks", F.ceil(F.col("_blocks") / 2)), "block-pairs")
        names = assign_ids(pairs.select("_left", "_right").distinct(), "_name", 1, ["_left", "_right"])
        occurrences = stage(pairs.join(names, ["_left", "_right"]).drop("_left", "_right"), "block-names")
        most, level = (most + 1) // 2, level + 1


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    address_bits: int = ADDRESS_BITS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are, byte for byte; a NULL text counts as
    empty, and all empty texts form one group. The row with the largest id
    stays. Rows that repeat id and text all come out, and at most one of them
    is kept; rows of one id with different texts are different documents. A
    NULL id loses to any other and forms its own keeper if it is alone. An
    empty table gives no row. Other columns are ignored, whatever their names.

    `address_bits` narrows the addresses under which blocks meet; results do
    not depend on it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    address = F.xxhash64("_block")
    if address_bits < 64:
        address = F.shiftrightunsigned(address, 64 - address_bits)
    cut = _blocks(text, block_bytes)
    source = df.select(F.col(id_col).alias("_id"), text.alias("_text"))
    blocks = source.select(F.explode(_blocks(F.col("_text"), block_bytes)).alias("_block"))
    names = _name_blocks(blocks.select(address.alias("_addr"), "_block"), address_bits)

    shape = df.select(
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("_sha"),
        F.greatest(F.ceil(F.octet_length(text) / F.lit(float(block_bytes))), F.lit(1)).cast("long").alias("_blocks"),
        F.posexplode(cut).alias("_pos", "_block"),
    ).withColumn("_addr", address)
    crowded = names.filter("_only is not null")
    places = shape.select("_id", "_sha", "_blocks", "_pos", "_addr", F.lit(1).cast("long").alias("_reps"))
    occurrences = places.join(names.filter("_only is null").select("_addr", "_name"), "_addr").drop("_addr")
    if address_bits < 64 or not crowded.isEmpty():
        exact = crowded.select(F.col("_addr").alias("_at"), "_only", "_name")
        met = shape.join(exact, (F.col("_addr") == F.col("_at")) & (F.col("_block") == F.col("_only")))
        met = met.select("_id", "_sha", "_blocks", "_pos", F.lit(1).cast("long").alias("_reps"), "_name")
        occurrences = occurrences.unionByName(met)
    done = _name_documents(stage(occurrences, "block-names"))

    named = done[0]
    for part in done[1:]:
        named = named.unionByName(part)
    groups = named.groupBy("_level", "_name").agg(
        F.max("_id").alias("keep_id"), F.sum("_reps").cast("long").alias("group_size")
    )
    # Written, so that the join below does not inherit the aggregate's partitions: only then can a hot group be split.
    groups = stage(groups, "copy-groups")
    rows = named.join(groups, ["_level", "_name"]).withColumn(
        "_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_reps")))
    )
    return rows.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the frame that `exact_dedup` keeps, with all their columns.

    Of rows that repeat id and text, the one with the least other columns stays.
    """
    kept = exact_dedup(df, id_col, text_col, **options).filter("kept")
    kept = kept.select(F.col(id_col).alias("_by"), F.unhex("text_sha256").alias("_sha"))
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    rows = df.select(F.col(id_col).alias("_by"), sha.alias("_sha"), F.struct("*").alias("_row"))
    same = F.col("r._by").eqNullSafe(F.col("k._by")) & (F.col("r._sha") == F.col("k._sha"))
    met = rows.alias("r").join(kept.alias("k"), same, "left_semi")
    return met.groupBy("_by", "_sha").agg(F.min("_row").alias("_row")).select("_row.*")


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
