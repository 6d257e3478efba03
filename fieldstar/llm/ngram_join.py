"""N-gram Jaccard join by MinHash banding.

Texts are sets of word n-grams. Texts whose sets have a Jaccard similarity of at
least the threshold are linked; links chain into classes. Bands and rows are
chosen for a target recall at the threshold, documents meet under equal band
hashes, and every pair that meets is verified on the full n-gram sets.

Plan at scale:

* One map computes signatures and writes them (a copy key and one integer per
  band). Exact copies collapse first, with early reduction, so a group of copies
  is one node whatever its size; its links count with its number of copies.
* Band hashes are shuffled without text. Buckets of one node go; of buckets
  with the same members one stays. A node's text then travels only to the
  buckets it shares.
* A bucket is verified in blocks of at most BLOCK nodes, every pair of blocks
  in its own group, so no task holds a large bucket. A pair is counted in the
  first band in which it agrees, which decides it once without a list of pairs;
  tasks return link counts per node and a spanning forest of the links.
* Classes are the connected components of those forests, found by passing on
  least labels with pointer jumping, written to the shared folder every round.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import query, table
from fieldstar.session import ship_package, stage

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 128
BLOCK = 1000
KNOWN_WORDS = 500_000
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def choose_bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band that reach the recall at the threshold with at most `most` hashes."""
    fit = (1, 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            fit = (bands, rows)
    return fit


class WordHashes(dict):
    """64-bit hashes of words, kept in a table that is emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def ngram_set(text: bytes, n: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; a shorter text has one n-gram, one without words none."""
    words = text.split()
    if not words:
        return np.zeros(0, "u8")
    own = np.fromiter(map(known.__getitem__, words), "u8", len(words))
    n = min(n, len(words))
    grams = np.full(len(words) - n + 1, n, "u8")
    for k in range(n):
        grams = (grams ^ (grams >> np.uint64(29))) * PRIME + own[k : len(own) - n + 1 + k]
    grams = (grams ^ (grams >> np.uint64(32))) * MIX
    return np.unique(grams ^ (grams >> np.uint64(29)))


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band over the least values of `rows` hash functions."""
    factors, shifts = _functions(bands * rows)
    least = np.full(bands * rows, np.iinfo("u8").max, "u8")
    for at in range(0, len(grams), 256):
        np.minimum(least, (grams[at : at + 256, None] * factors + shifts).min(0), out=least)
    least = least.reshape(bands, rows)
    found = np.arange(bands, dtype="u8")
    for k in range(rows):
        found = (found ^ (least[:, k] >> np.uint64(17))) * PRIME + least[:, k]
    return (found ^ (found >> np.uint64(31))).view("i8")


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(5)
    return draw.integers(0, 1 << 63, count, "u8") * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, count, "u8")


class Forest:
    """Union-find over the nodes a task has met."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        up = self.up
        top = node
        while (above := up.get(top, top)) != top:
            top = above
        while (above := up.get(node, node)) != top:
            up[node], node = top, above
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(node, root) for node in self.up if (root := self.root(node)) != node]


def linked(sets: list[np.ndarray], pairs: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (rows of two places) have a Jaccard similarity of at least the threshold."""
    sizes = np.array([len(s) for s in sets])
    a, b = pairs[:, 0], pairs[:, 1]
    near = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b]) - 1e-9
    if len(pairs) > 2000:
        shared = _shared_counts(sets)[a, b]
    else:
        shared = np.zeros(len(pairs), "i8")
        for k in np.flatnonzero(near):
            shared[k] = len(np.intersect1d(sets[a[k]], sets[b[k]], assume_unique=True))
    return near & (shared >= threshold * (sizes[a] + sizes[b] - shared) - 1e-9)


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share; n-grams of the same sets are counted as one column."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(flat, return_inverse=True)
    counts = np.bincount(column)
    row, column = row[counts[column] > 1], column[counts[column] > 1]
    found = np.zeros((len(sets), len(sets)), "f4")
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    for first in range(0, len(starts), 4096):
        lo = starts[first]
        hi = starts[first + 4096] if first + 4096 < len(starts) else len(row)
        held = np.zeros((len(sets), min(4096, len(starts) - first)), "f4")
        held[row[lo:hi], np.cumsum(np.r_[0, column[lo + 1 : hi] != column[lo : hi - 1]])] = 1
        found += held @ held.T
    return found.astype("i8")


def _verified(batches, n: int, threshold: float):
    """Link counts and forest edges from rows sorted by (bucket, lo, hi); a group never exceeds two blocks."""
    known, forest, links = WordHashes(), Forest(), {}

    def settle(group: list[tuple]) -> None:
        band, lo, hi = group[0][1:4]
        nodes, copies, blocks = (np.array([g[k] for g in group]) for k in (4, 5, 6))
        hashes = np.array([g[7] for g in group])
        fresh = np.triu(np.ones((len(group), len(group)), bool), 1) & (nodes[:, None] != nodes)
        if lo != hi:
            fresh &= blocks[:, None] != blocks
        for k in range(band):
            fresh &= hashes[:, None, k] != hashes[None, :, k]
        pairs = np.argwhere(fresh)
        if not len(pairs):
            return
        met, place = np.unique(pairs, return_inverse=True)
        sets = [ngram_set(group[k][8], n, known) for k in met]
        for a, b in pairs[linked(sets, place.reshape(pairs.shape), threshold)]:
            left, right = int(nodes[a]), int(nodes[b])
            links[left] = links.get(left, 0) + int(copies[b])
            links[right] = links.get(right, 0) + int(copies[a])
            forest.join(left, right)

    group: list[tuple] = []
    for batch in batches:
        columns = [batch.column(k) for k in range(8)] + [batch.column(8).cast(pa.binary())]
        for row in zip(*[c.to_pylist() for c in columns], strict=True):
            if group and row[:4] != group[0][:4]:
                settle(group)
                group = []
            group.append(row)
    if group:
        settle(group)
    found = [(node, None, count) for node, count in links.items()] + [(*edge, None) for edge in forest.edges()]
    columns = zip(*found, strict=True) if found else ([], [], [])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "root", "links"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of the edges (node, root) is connected to."""
    both = edges.select(F.col("node").alias("_a"), F.col("root").alias("_b"))
    both = stage(both.union(both.select("_b", "_a")).distinct(), "links")
    labels = both.groupBy(F.col("_a").alias("node")).agg(F.least(F.min("_b"), F.first("_a")).alias("label"))
    labels = stage(labels, "labels")
    while True:
        heard = both.join(labels, both["_b"] == labels["node"]).groupBy("_a").agg(F.min("label").alias("_heard"))
        heard = stage(heard, "heard")  # so that the joins below can split a hot label
        lower = labels.join(heard, labels["node"] == heard["_a"]).select(
            "node", F.least("label", "_heard").alias("_low"), "label"
        )
        jump = labels.select(F.col("node").alias("_at"), F.col("label").alias("_further"))
        lower = lower.join(jump, F.col("_low") == F.col("_at")).select(
            "node", F.least("_low", "_further").alias("label"), F.col("label").alias("_old")
        )
        lower = stage(lower, "labels")
        labels = lower.select("node", "label")
        if lower.filter("label < _old").isEmpty():
            return labels


def ngram_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, class_id, copy_id, n_copies, n_links, kept, text_md5.

    `copy_id` is the least id of the rows with the same text and `n_copies`
    their number; `n_links` counts the other rows whose n-gram sets are similar
    enough, copies included; `class_id` is the least id linked directly or over
    others. `kept` marks one row per class, that of the least id.

    A text of fewer words than an n-gram is one n-gram. NULL, empty and blank
    texts have no n-grams and no links: each such row is a class of its own and
    kept. NULL ids come before all others; rows that repeat an id are rows like
    any other, and of rows that tie for the least id one is kept. An empty
    table gives no row. Other columns are ignored.
    """
    bands, rows = choose_bands(threshold, recall)
    ship_package(df.sparkSession)

    def sign(batches):
        known = WordHashes()
        for batch in batches:
            keys, hashes = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                keys.append(hashlib.md5(text or b"", usedforsecurity=False).digest())
                grams = ngram_set(text or b"", words, known)
                hashes.append(signature(grams, bands, rows) if len(grams) else None)
            columns = [batch.column(0), pa.array(keys, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_copy", "_bands"])

    kind = dict(df.dtypes)[id_col]
    own = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    signed = own.mapInArrow(sign, f"_id {kind}, _copy binary, _bands array<long>")
    signed = stage(signed.withColumn("_row", F.monotonically_increasing_id()), "signatures")

    first = F.min(F.struct("_id", "_row", "_bands"))
    nodes = signed.filter("_bands is not null").groupBy("_copy").agg(first.alias("_first"), F.count("*").alias("_n"))
    nodes = stage(nodes.select("_copy", "_first.*", "_n"), "nodes")

    met = nodes.select(F.col("_row").alias("_node"), F.posexplode("_bands").alias("_band", "_hash"))
    name = F.xxhash64("_node")
    buckets = met.groupBy("_band", "_hash").agg(
        F.count("*").alias("_size"), F.bit_xor(name).alias("_who"), F.min("_node").alias("_lo"), F.max("_node").alias("_hi")
    )
    alike = buckets.filter("_size > 1").groupBy("_size", "_who", "_lo", "_hi")
    kept = stage(alike.agg(F.min(F.struct("_band", "_hash")).alias("_b")).select("_b.*", "_size"), "buckets")

    parts = F.ceil(F.col("_size") / F.lit(float(block))).cast("long")
    members = met.join(kept, ["_band", "_hash"]).withColumn("_parts", parts)
    members = members.withColumn("_block", F.pmod(F.xxhash64("_node", F.lit(1)), F.col("_parts")))
    members = members.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    groups = members.select(
        F.col("_hash"), F.col("_band"), F.least("_block", "_other").alias("_lo"), F.greatest("_block", "_other").alias("_hi"),
        F.col("_node"), F.col("_block"),
    )
    wanted = met.join(kept, ["_band", "_hash"], "left_semi").select("_node").distinct()
    wanted = stage(nodes.join(wanted, nodes["_row"] == wanted["_node"]).select(
        "_node", F.col("_id").alias("_of"), F.col("_copy").alias("_key"), "_n", "_bands"
    ), "candidates")
    keyed = own.select("_id", F.unhex(F.md5(F.coalesce(F.col("_text"), F.lit("")).cast("binary"))).alias("_copy"), "_text")
    texts = keyed.join(wanted, F.col("_copy").eqNullSafe(F.col("_key")) & F.col("_id").eqNullSafe(F.col("_of")))
    # Rows that repeat id and text all meet their node: one text each.
    texts = texts.select(F.col("_node").alias("_at"), "_n", "_bands", "_text").dropDuplicates(["_at"])
    dealt = groups.join(texts, F.col("_node") == F.col("_at")).select(
        "_hash", "_band", "_lo", "_hi", "_node", "_n", "_block", "_bands", "_text"
    )
    order = ["_hash", "_band", "_lo", "_hi"]
    dealt = dealt.repartition(*order).sortWithinPartitions(*order)
    found = dealt.mapInArrow(lambda b: _verified(b, words, threshold), "node long, root long, links long")
    found = stage(found, "verified")

    counts = found.filter("root is null").groupBy("node").agg(F.sum("links").alias("_links"))
    labels = components(found.filter("root is not null").select("node", "root"))
    of_nodes = (
        nodes.select("_copy", "_row", "_id", "_n")
        .join(counts.withColumnRenamed("node", "_row"), "_row", "left")
        .join(labels.withColumnRenamed("node", "_row"), "_row", "left")
        .select("_copy", "_row", F.col("_id").alias("copy_id"), "_n", "_links", F.coalesce("label", "_row").alias("_label"))
    )
    of_nodes = stage(of_nodes, "node-classes")
    least = of_nodes.groupBy("_label").agg(F.min(F.struct("copy_id", "_row")).alias("_least"))
    least = stage(least.select(F.col("_label").alias("_class"), "_least"), "classes")
    classed = of_nodes.join(least, F.col("_label") == F.col("_class")).select(
        F.col("_copy").alias("_key"), "copy_id", "_n", "_links", "_least"
    )
    rows_out = signed.select("_id", "_row", "_copy", F.col("_bands").isNull().alias("_bare"))
    joined = rows_out.join(classed, (F.col("_copy") == F.col("_key")) & ~F.col("_bare"), "left")
    bare = F.col("_bare")
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(bare, F.col("_id")).otherwise(F.col("_least.copy_id")).alias("class_id"),
        F.when(bare, F.col("_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(bare, 1).otherwise(F.col("_n")).cast("long").alias("n_copies"),
        F.when(bare, 0).otherwise(F.col("_n") - 1 + F.coalesce("_links", F.lit(0))).cast("long").alias("n_links"),
        (bare | (F.col("_row") == F.col("_least._row"))).alias("kept"),
        F.lower(F.hex("_copy")).alias("text_md5"),
    )


def keep_one_of_similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the frame that `ngram_join` keeps, with all their columns.

    Of rows that repeat id and text, the one with the least other columns stays.
    """
    key = lambda c: F.unhex(F.md5(F.coalesce(c, F.lit("")).cast("binary")))
    kept = ngram_join(df, id_col, text_col, **options).filter("kept")
    kept = kept.select(F.col(id_col).alias("_by"), F.unhex("text_md5").alias("_copy")).distinct()
    rows = df.select(F.col(id_col).alias("_by"), key(F.col(text_col)).alias("_copy"), F.struct("*").alias("_row"))
    same = F.col("r._by").eqNullSafe(F.col("k._by")) & (F.col("r._copy") == F.col("k._copy"))
    met = rows.alias("r").join(kept.alias("k"), same, "left_semi")
    return met.groupBy("_by", "_copy").agg(F.min("_row").alias("_row")).select("_row.*")


@query("op4_ngram_join")
def op4_ngram_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"))
