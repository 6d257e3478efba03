"""Best-fit packing of token sequences, in bulk-synchronous sweeps.

Documents become token ids plus an end id; those longer than the capacity are
cut into pieces of it. Pieces are sorted by length over all tasks, the longest
first, and each learns its rank. Then rounds of sweeps run on two kinds of small
rows, pieces without a place and sequences with their gaps:

* A sweep sorts gaps and pieces together by size, the largest first, over all
  tasks. A piece takes the smallest gap that holds it (its successor) and that
  no piece of lower rank has taken. In sorted order that is a matching of
  brackets: a gap opens one, a piece closes the last one that is open. The depth
  is a running sum, and partners are neighbours among the rows of equal depth:
  within blocks of the order first, then among the few rows a block has left over.
* Gaps are updated, and sweeps are repeated, over the longest pieces first, until
  nothing fits any more.
* Then as many sequences are opened as the tokens that are left must have at
  least, each with one of the longest pieces that are left, and sweeps go on.

A sweep asks for nothing but sizes and their order, and sizes are few. So the
sweeps run on runs of neighbours in that order that are alike: pieces of one
size, gaps of one size opened by pieces in a row. A run matched with a run is
one step however long both are, and a sweep cuts no more runs than there are
sizes: what the sweeps cost depends on the capacity, not on the table. Where
there are more than `MOST_SIZES` sizes, the same sweeps run on rows, as above.

Very short pieces in numbers that sequences cannot take one per sweep are put
together first, equal lengths to bundles of up to `BUNDLE` tokens, but for the
shortest, which fill the last gaps. So the number of sweeps depends on the
capacity, not on the table.

Plan at scale: tokenizing is a map; its pieces (five numbers) are written once
and sorted over all tasks. The driver sees the number of pieces per size and
works out the runs; each task looks its rows' ranks up in them. Sweeps on rows
move four numbers each, and of pieces only those that have no place yet; they
collect none, and each sweep's rows are written, so that a lost executor costs
one sweep.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from fieldstar.llm.common import query, table
from fieldstar.llm.tokens import encoder
from fieldstar.operators.keys import assign_ids
from fieldstar.session import ship_package, stage

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
# Short pieces may be put together up to the capacity over this.
BUNDLE = 16
BLOCK_ROWS = 1 << 16
# Distinct sizes whose sweeps run on runs.
MOST_SIZES = 1 << 13
TEXTS_AT_ONCE = 4000
BYTES_AT_ONCE = 4_000_000


def _slices(texts: pa.Array):
    """(first row, rows) of parts of a batch that hold few texts and few bytes."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, min(at + TEXTS_AT_ONCE, int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right"))))
        yield at, end - at
        at = end


def cut_pieces(ids: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """(text, piece, start, length, crc32) of the pieces of texts whose ids stand in a row, an end id after each."""
    whole = sizes + 1
    first = np.cumsum(whole) - whole
    ended = np.zeros(int(whole.sum()), "<u4")
    ended[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
    pieces = -(-whole // capacity)
    text = np.repeat(np.arange(len(sizes)), pieces)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    length = np.minimum(capacity, whole[text] - start)
    raw, at = memoryview(ended).cast("B"), (first[text] + start) * 4
    crc = [zlib.crc32(raw[a : a + n]) for a, n in zip(at.tolist(), (length * 4).tolist(), strict=True)]
    return text, piece.astype("i4"), start, length, np.array(crc, "i8")


def token_pieces(df: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: str) -> DataFrame:
    """One row per piece of at most `capacity` ids: id, piece, start, length, ids_crc32."""

    def cut(batches):
        # What earlier stages of this worker left to its memory pool goes back to the machine.
        pa.default_memory_pool().release_unused()
        encode = encoder(vocabulary).encode
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at, many in _slices(texts):
                row, *found = cut_pieces(*encode(texts.slice(at, many)), capacity)
                columns = [ids.take(pa.array(row + at)), *[pa.array(c) for c in found]]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "piece", "start", "length", "ids_crc32"]
    kind = dict(df.dtypes)[id_col]
    ship_package(df.sparkSession)
    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long"
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(cut, schema)


GAP, PIECE = 0, 1


def _partnered(rows: DataFrame, *by: str) -> DataFrame:
    """Rows with `_partner`: of a piece the gap before it among the rows of its level, of a gap the piece after it."""
    who = F.struct("_kind", "_key", "_size")
    level = Window.partitionBy(*by).orderBy("_at")
    before, after = F.lag(who).over(level), F.lead(who).over(level)
    met = rows.withColumns({"_before": before, "_after": after})
    of_piece = F.when(F.col("_before._kind") == GAP, F.col("_before"))
    of_gap = F.when(F.col("_after._kind") == PIECE, F.col("_after"))
    return met.withColumn("_partner", F.when(F.col("_kind") == PIECE, of_piece).otherwise(of_gap)).drop("_before", "_after")


def match_best_fit(rows: DataFrame) -> DataFrame:
    """One sweep over (_kind, _key, _size): each piece, the largest first, takes the smallest free gap that holds it.

    Returns the rows with `_partner`, the (_kind, _key, _size) each was matched
    with, if any. Equal sizes go by key; a gap takes one piece at most.
    """
    down = rows.withColumn("_down", -F.col("_size"))
    ordered = assign_ids(down, "_at", 0, ["_down", "_kind", "_key"]).drop("_down")
    ordered = ordered.withColumn("_block", F.floor(F.col("_at") / BLOCK_ROWS))
    step = F.when(F.col("_kind") == GAP, 1).otherwise(-1)
    sums = ordered.groupBy("_block").agg(F.sum(step).alias("_sum"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = ordered.withColumn("_run", F.sum(step).over(inside)).join(carried, "_block")
    # The depth on the inner side of the row: after a gap has opened, before a piece closes.
    level = F.col("_carried") + F.col("_run") + F.when(F.col("_kind") == PIECE, 1).otherwise(0)
    near = _partnered(walked.withColumn("_level", level).drop("_run", "_carried"), "_block", "_level")
    # What a block leaves over is one piece and one gap per level at most.
    far = _partnered(near.filter("_partner is null").drop("_partner"), "_level")
    both = near.filter("_partner is not null").unionByName(far)
    return both.drop("_at", "_block", "_level")


def _bundled(pieces: DataFrame, counts: dict[int, int], capacity: int) -> DataFrame:
    """Pieces with `_item`: their rank, or that of the first piece of their bundle."""
    total, tokens = sum(counts.values()), sum(n * k for n, k in counts.items())
    spared = total - 2 * -(-tokens // capacity)
    bundle = capacity // BUNDLE
    first, rank = {}, 0
    for length in sorted(counts, reverse=True):
        first[length], rank = rank, rank + counts[length]
    # At most `bundle` numbers: the first rank of each short length.
    firsts = F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(bundle + 1)])
    of_length = F.get(firsts, F.col("length").cast("int"))
    many = F.floor(F.lit(bundle) / F.col("length"))
    item = of_length + F.floor((F.col("_rank") - of_length) / many) * many
    short = (F.col("length") <= bundle) & (F.col("_rank") < spared)
    return pieces.withColumn("_item", F.when(short, item).otherwise(F.col("_rank")).cast("long"))


def _totals(capacity: int) -> list[Column]:
    """What the driver decides by: pieces without a place by size, and the largest gap."""
    free = (F.col("_kind") == PIECE) & F.col("_other").isNull()
    size = F.when(free, F.col("_size"))
    least = [F.min(F.when(F.col("_size") > above, size)).alias(f"least{i}") for i, above in enumerate(_classes(capacity))]
    return [
        F.count_if((F.col("_kind") == PIECE) & F.col("_other").isNotNull()).alias("matched"),
        F.coalesce(F.sum(size), F.lit(0)).alias("tokens"),
        F.count_if(free & (F.col("_size") > capacity // 2)).alias("large"),
        F.max(F.when(F.col("_kind") == GAP, F.col("_size"))).alias("gap"),
        *least,
    ]


def _classes(capacity: int) -> list[int]:
    """Sizes above which pieces take part in the sweeps, class after class."""
    return [capacity // 2, capacity // 4, capacity // 8, 0]


def _written(rows: DataFrame, capacity: int) -> tuple[DataFrame, dict]:
    seen = Observation()
    return stage(rows.observe(seen, *_totals(capacity)), "packing-sweep"), seen.get


def _live(state: DataFrame) -> DataFrame:
    """Gaps, and pieces without a place."""
    return state.filter((F.col("_kind") == GAP) | F.col("_other").isNull()).drop("_other")


def _merged(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs (size, first, many) by falling size and rising place, neighbours of one size made one."""
    found: list[tuple[int, int, int]] = []
    for size, first, many in sorted(runs, key=lambda r: (-r[0], r[1])):
        if found and found[-1][0] == size and found[-1][1] + found[-1][2] == first:
            size, first, many = size, found[-1][1], found.pop()[2] + many
        found.append((size, first, many))
    return found


def _sweep_runs(gaps: list, pieces: list, above: int, least: int) -> tuple[list, list, list]:
    """`match_best_fit` of pieces above a size and gaps of at least one, both runs (size, first, many) in `_merged` order.

    Returns gaps and pieces that are left, and what was placed: (first piece, many, its gap, -1), the gap of each next
    piece being the one before.
    """
    open_, left, after, placed, at = [], [], [], [], 0
    for size, first, many in pieces:
        while at < len(gaps) and gaps[at][0] >= max(size, least):
            open_.append(gaps[at])
            at += 1
        while many and open_ and size > above:
            room, start, free = open_.pop()
            some = min(many, free)
            placed.append((first, some, start + free - 1, -1))
            after.append((room - size, start + free - some, some))
            if free > some:
                open_.append((room, start, free - some))
            first, many = first + some, many - some
        if many:
            left.append((size, first, many))
    return _merged([r for r in open_ + gaps[at:] + after if r[0]]), left, placed


def place_runs(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (first, many, sequence, step) for items numbered by falling size, of which `counts` has the number per size.

    Item `first + i` lies in sequence `sequence + i * step`; sequences are named by their first item.
    """
    pieces, placed, at = [], [], 0
    for size in sorted(counts, reverse=True):
        pieces.append((size, at, counts[size]))
        at += counts[size]
    gaps: list[tuple[int, int, int]] = []
    while pieces:
        tokens = sum(size * many for size, _, many in pieces)
        needed = max(-(-tokens // capacity), sum(many for size, _, many in pieces if size > capacity // 2))
        rest = []
        for size, first, many in pieces:
            opened = min(many, needed)
            needed -= opened
            if opened:
                placed.append((first, opened, first, 1))
                gaps.append((capacity - size, first, opened))
            if many > opened:
                rest.append((size, first + opened, many - opened))
        gaps, pieces = _merged([g for g in gaps if g[0]]), rest
        for above in _classes(capacity):
            while gaps and (sizes := [size for size, _, _ in pieces if size > above]) and gaps[0][0] >= min(sizes):
                gaps, pieces, found = _sweep_runs(gaps, pieces, above, min(sizes))
                placed += found
    return np.array(sorted(placed), "i8").reshape(-1, 4)


def _looked_up(items: DataFrame, runs: np.ndarray) -> DataFrame:
    """(_key, _nth, _open): the items with their sequence's number."""

    def look(batches):
        for batch in batches:
            nth = batch.column("_nth").to_numpy()
            first, _, sequence, step = runs[np.searchsorted(runs[:, 0], nth, side="right") - 1].T
            found = pa.array(sequence + (nth - first) * step)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_nth"), found], ["_key", "_nth", "_open"])

    ship_package(items.sparkSession)
    return items.select("_key", "_nth").mapInArrow(look, "_key long, _nth long, _open long")


def place_items(items: DataFrame, capacity: int) -> DataFrame:
    """(_item, _seq) for items (_key, _size) below the capacity: sequences are named by their first item."""
    down = items.select(F.col("_key").cast("long"), F.col("_size").cast("long"), (-F.col("_size")).alias("_down"))
    ranked = assign_ids(down, "_nth", 0, ["_down", "_key"]).drop("_down")
    counts = ranked.groupBy("_size").count().limit(MOST_SIZES + 1).collect()
    if len(counts) > MOST_SIZES:
        return _place_rows(ranked.select("_key", "_size"), capacity)
    met = _looked_up(ranked, place_runs({row["_size"]: row["count"] for row in counts}, capacity))
    opened = met.filter("_nth = _open").select("_open", F.col("_key").alias("_seq"))
    return met.join(opened, "_open").select(F.col("_key").alias("_item"), "_seq")


def _place_rows(items: DataFrame, capacity: int) -> DataFrame:
    """`place_items` by sweeps on rows."""
    none = F.lit(None).cast("long").alias("_other")
    state, now = _written(items.select(F.lit(PIECE).alias("_kind"), "_key", "_size", none), capacity)
    found = []
    while now["tokens"]:
        needed = max(-(-now["tokens"] // capacity), now["large"])
        free = _live(state)
        ranked = free.filter(F.col("_kind") == PIECE).withColumn("_down", -F.col("_size"))
        ranked = assign_ids(ranked, "_nth", 0, ["_down", "_key"]).drop("_down")
        opens = F.col("_nth") < needed
        opened = ranked.filter(opens).select(
            F.lit(GAP).alias("_kind"), "_key", (F.lit(capacity) - F.col("_size")).alias("_size"), none
        )
        found.append(opened.select(F.col("_key").alias("_item"), F.col("_key").alias("_seq")))
        rest = ranked.filter(~opens).select("_kind", "_key", "_size", none)
        gaps = free.filter(F.col("_kind") == GAP).select("_kind", "_key", "_size", none)
        state, now = _written(gaps.unionByName(opened).unionByName(rest), capacity)
        for i, above in enumerate(_classes(capacity)):
            while now[f"least{i}"] is not None and now["gap"] is not None and now["gap"] >= now[f"least{i}"]:
                state, now = _sweep(state, above, now[f"least{i}"], capacity)
                placed = state.filter((F.col("_kind") == PIECE) & F.col("_other").isNotNull())
                found.append(placed.select(F.col("_key").alias("_item"), F.col("_other").alias("_seq")))
    return reduce(DataFrame.unionByName, found) if found else items.select(F.col("_key").alias("_item"), F.col("_key").alias("_seq"))


def _sweep(state: DataFrame, above: int, least: int, capacity: int) -> tuple[DataFrame, dict]:
    """Match the pieces above a size with the gaps that hold the least of them; all other rows stay as they are."""
    rows = _live(state)
    taking = F.when(F.col("_kind") == GAP, F.col("_size") >= least).otherwise(F.col("_size") > above)
    swept = match_best_fit(rows.filter(taking))
    left = F.when(F.col("_kind") == GAP, F.col("_size") - F.coalesce(F.col("_partner._size"), F.lit(0)))
    swept = swept.select("_kind", "_key", left.otherwise(F.col("_size")).alias("_size"), F.col("_partner._key").alias("_other"))
    rest = rows.filter(~taking).withColumn("_other", F.lit(None).cast("long"))
    return _written(swept.unionByName(rest), capacity)


def pack_best_fit(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A NULL or empty text is its end id alone: one piece of length 1. Rows that
    repeat an id are packed each, as any other document. Equal lengths take
    places in the order of id and piece. An empty table gives no row. Other
    columns are ignored. Within a sequence the pieces lie gapless from 0, the
    longest first.
    """
    pieces = stage(token_pieces(df, id_col, text_col, capacity, vocabulary), "pieces")
    pieces = pieces.withColumn("_shortness", -F.col("length"))
    ranked = assign_ids(pieces, "_rank", 0, ["_shortness", "_id", "piece"]).drop("_shortness")
    # At most `capacity` counts.
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    whole = counts.pop(capacity, 0)
    full = F.col("length") == capacity
    # Whole pieces have the lowest ranks; the others count from the first one behind them.
    bundled = _bundled(ranked.filter(~full).withColumn("_rank", F.col("_rank") - whole), counts, capacity)
    items = bundled.groupBy(F.col("_item").alias("_key")).agg(F.sum("length").alias("_size"))
    places = place_items(items, capacity)

    met = bundled.join(places, "_item").drop("_item")
    # Sequences of one whole piece are named below zero, so that names never meet.
    alone = ranked.filter(full).withColumn("_seq", -F.col("_rank") - 1)
    before = Window.partitionBy("_seq").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    names = [F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("_seq").alias("sequence_id")]
    return met.select(*names, offset.alias("offset")).unionByName(
        alone.select(*names, F.lit(0).cast("long").alias("offset"))
    )


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    return pack_best_fit(table(spark, sf_dir, "documents"))
