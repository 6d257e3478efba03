"""Rules checked on what is added, not on everything again.

The keys a table holds are summed up in a Bloom filter that is itself a small
table: bits in blocks of 32,768, one row per block. New keys that miss a bit are
new for certain; only the others, a few in a hundred at most, are looked up among
the stored keys. Nothing of the stored tables is shuffled for keys that cannot
be there, and a filter grows by the keys of each increment.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.operators.constraints import null_violations, violation_rows
from fieldstar.operators.joins import anti_new
from fieldstar.schema import RULES
from fieldstar.session import stage

PROBES = 5
BLOCK_BITS = 32_768  # fixed value: bits per row of Spark's bitmap functions


@dataclass(frozen=True)
class KeyFilter:
    """Which keys a table may hold: (block, bits) rows, and the number of blocks they are dealt to."""

    bits: DataFrame
    blocks: int


def _probes(key: Column, blocks: int) -> Column:
    """Bit numbers of a key, one per probe."""
    total = F.lit(blocks * BLOCK_BITS)
    text = key.cast("string")
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), text), total) for i in range(PROBES)])


def _keys(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(f"`{col}`").alias("_key")).filter("_key is not null")


def key_filter(df: DataFrame, col: str, keys: int) -> KeyFilter:
    """Filter over a column's values, sized for that many keys (about 8 bits each).

    More keys than that make more candidates, never a wrong answer.
    """
    blocks = max(1, -(-keys * 8 // BLOCK_BITS))
    return KeyFilter(_bits(_keys(df, col), blocks), blocks)


def _bits(keys: DataFrame, blocks: int) -> DataFrame:
    places = keys.select(F.explode(_probes(F.col("_key"), blocks)).alias("_bit"))
    # Block number and place in it are the built-in functions' own, so that their bitmaps can be united.
    grouped = places.groupBy(F.bitmap_bucket_number("_bit").alias("block"))
    return grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))


def with_keys_added(known: KeyFilter, df: DataFrame, col: str) -> KeyFilter:
    """The filter over its keys and the frame's together."""
    both = known.bits.unionByName(_bits(_keys(df, col), known.blocks))
    return KeyFilter(both.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")), known.blocks)


def maybe_known(keys: DataFrame, known: KeyFilter) -> DataFrame:
    """Distinct `_key` rows that the filter does not rule out."""
    places = keys.select("_key", F.explode(_probes(F.col("_key"), known.blocks)).alias("_bit")).select(
        "_key", F.bitmap_bucket_number("_bit").alias("block"), F.bitmap_bit_position("_bit").alias("_at")
    )
    byte = F.substring("bits", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("_at") % 8).cast("int")).cast("int")
    met = places.join(known.bits, "block")
    hits = met.groupBy("_key").agg(F.sum(bit).alias("_hits"))
    return hits.filter(F.col("_hits") == PROBES).select("_key")


def _stored(candidates: DataFrame, table: DataFrame, col: str) -> DataFrame:
    """(_key, _n): stored rows of each candidate; the stored keys are only read if there is one."""
    candidates = stage(candidates, "candidate-keys")
    if candidates.isEmpty():
        return candidates.withColumn("_n", F.lit(0).cast("long"))
    met = _keys(table, col).join(candidates, "_key", "left_semi")
    return met.groupBy("_key").agg(F.count("*").alias("_n"))


def check_increment(
    stored: Mapping[str, DataFrame], added: Mapping[str, DataFrame], filters: Mapping[str, Mapping[str, KeyFilter]]
) -> DataFrame:
    """Violations that the added rows bring to stored tables which had none: those of both together.

    `filters` has a filter over the stored values of every unique column that
    is to be checked, by table and column; a column without one has its stored
    values joined whole.
    """
    found = []
    for table, df in added.items():
        rules = RULES[table]
        found.append(null_violations(df, table))
        for col in dict.fromkeys([rules.primary, *rules.unique]):
            if col in df.columns:
                found.append(_repeated(stored, df, table, col, filters))
        for col, parent in rules.foreign.items():
            if col in df.columns and (parent in stored or parent in added):
                found.append(_orphans(stored, added, df, table, col, parent, filters))
    return reduce(DataFrame.unionByName, found)


def _among_stored(keys: DataFrame, stored: Mapping[str, DataFrame], table: str, col: str, filters: Mapping) -> DataFrame:
    """(_key, _n) of the keys that stored rows have."""
    if table not in stored:
        return keys.select("_key", F.lit(0).cast("long").alias("_n")).limit(0)
    known = filters.get(table, {}).get(col)
    return _stored(maybe_known(keys, known) if known else keys, stored[table], col)


def _repeated(stored: Mapping, df: DataFrame, table: str, col: str, filters: Mapping) -> DataFrame:
    own = stage(_keys(df, col).groupBy("_key").agg(F.count("*").alias("_own")), "added-keys")
    there = _among_stored(own.select("_key"), stored, table, col, filters)
    met = own.join(there, "_key", "left").withColumn("n", F.col("_own") + F.coalesce("_n", F.lit(0)))
    return violation_rows(met.filter("n > 1"), table, "unique", col, F.col("_key"), F.col("n"))


def _orphans(
    stored: Mapping, added: Mapping, df: DataFrame, table: str, col: str, parent: str, filters: Mapping
) -> DataFrame:
    primary = RULES[parent].primary
    values = _keys(df, col).groupBy("_key").agg(F.count("*").alias("n"))
    if parent in added:
        values = anti_new(values, added[parent], {"_key": primary})
    values = stage(values, "child-keys")
    there = _among_stored(values.select("_key"), stored, parent, primary, filters)
    orphans = values.join(there.select("_key"), "_key", "left_anti")
    return violation_rows(orphans, table, f"references {parent}", col, F.col("_key"), F.col("n"))
