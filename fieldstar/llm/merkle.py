"""Merkle manifest of a dataset: a digest per document, a root, and a proof for each document.

Leaves are ordered within each group (language) and every `FANOUT` consecutive
nodes become their hash, level by level, until a group has one node; the
groups' nodes likewise give the root.

A tree is worked off in aligned blocks of `BLOCK` leaves. A block keeps each of
its levels as one string of concatenated hex digests: fixed-width substrings of
a level are hashed to the next, and a node's siblings are the substrings on its
left and right flank. The tops of a tree's blocks are the leaves of a smaller
tree, which is worked off the same way, until every tree is one block.

Plan at scale:

* Leaves are hashed in one pass over the text; only ids and digests move on.
* Their order is a range partitioning with an offset per partition, so a group
  with most of all rows is numbered by as many tasks as it needs.
* Blocks are the unit of all later work: at most `BLOCK` leaves meet in a row,
  whatever the group's size, and each round has `BLOCK` times fewer rows.
* A proof is a path of flanks per level; blocks meet the path of their top (one
  row per block), and leaves are expanded last, so no join has a row per leaf.

Levels are binary columns that hold the hex text, as substrings of these do not
count code points. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import bind, query, table
from fieldstar.operators.keys import assign_ids
from fieldstar.session import stage

FANOUT = 2
DEPTH = 10
BLOCK = FANOUT**DEPTH
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
PATH = "array<struct<left:binary,right:binary>>"
EMPTY = b""


def digest(value: Column) -> Column:
    """Lower-case hex sha256, as bytes."""
    return F.sha2(value, 256).cast("binary")


def field_text(value: Column) -> Column:
    """A field as it enters a leaf: `-` if NULL, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return digest(F.concat(*[field_text(c) for c in fields]).cast("binary"))


def _part(level: Column, first: Column, nodes: Column | int) -> Column:
    """Some nodes of a level, from the given one on; cut at the level's end."""
    length = nodes * F.lit(WIDTH) if isinstance(nodes, Column) else F.lit(nodes * WIDTH)
    return F.substring(level, first * WIDTH + 1, length)


def _nodes(level: Column) -> Column:
    return (F.length(level) / WIDTH).cast("int")


def _parents(level: Column) -> Column:
    """The next level: every `FANOUT` consecutive digests hashed, the last run with those left."""
    runs = F.sequence(F.lit(0), F.ceil(_nodes(level) / FANOUT).cast("int") - 1)
    hashed = F.transform(runs, lambda i: F.sha2(_part(level, i * FANOUT, FANOUT), 256))
    return F.array_join(hashed, "").cast("binary")


def _levels(leaves: Column, many: Column) -> Column:
    """struct(levels, top): a block's levels that have a parent, and its last node.

    In a tree of many blocks every block has `DEPTH` levels; a block that is a
    whole tree ends with its root.
    """
    start = F.struct(F.array().cast("array<binary>").alias("levels"), leaves.alias("top"))

    def step(acc, _):
        grows = many | (_nodes(acc["top"]) > 1)
        return F.struct(
            F.when(grows, F.array_append(acc["levels"], acc["top"])).otherwise(acc["levels"]).alias("levels"),
            F.when(grows, _parents(acc["top"])).otherwise(acc["top"]).alias("top"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), start, step)


def _flanks(levels: Column, place: Column) -> Column:
    """Path of the node at a place of the lowest level: its siblings left and right, level by level."""

    def at(level, height):
        node = F.floor(place / F.pow(F.lit(float(FANOUT)), height)).cast("int")
        inside = node % FANOUT
        left = _part(level, node - inside, inside)
        right = _part(level, node + 1, F.lit(FANOUT - 1) - inside)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(levels, at)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    siblings = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return digest(F.aggregate(siblings, F.lit(EMPTY), lambda acc, s: F.concat(acc, s)))


def _blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One staged row per block: _tree, _block, _many, _members (by place), levels, top.

    `nodes` has _tree, _i (0-based place in its tree), _n (nodes of the tree), _node (hex digest) and the payload.
    """
    member = F.struct("_i", "_node", *payload)
    grouped = nodes.groupBy("_tree", F.floor(F.col("_i") / BLOCK).alias("_block")).agg(
        F.array_sort(F.collect_list(member)).alias("_members"), (F.max("_n") > BLOCK).alias("_many")
    )
    joined = F.array_join(F.transform("_members", lambda m: m["_node"].cast("string")), "").cast("binary")
    worked = bind(joined, lambda leaves: _levels(leaves, F.col("_many")))
    rows = grouped.select("_tree", "_block", "_many", "_members", worked.alias("_worked"))
    return stage(rows.select("*", "_worked.levels", "_worked.top").drop("_worked"), "merkle-blocks")


def _tree_paths(nodes: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """Blocks with the path above them, and (_tree, _root).

    The blocks are those of `_blocks` with `_above`: the path from the block's top to its tree's root.
    """
    blocks = _blocks(nodes, payload)
    none = F.array().cast(PATH)
    if blocks.filter("_many").isEmpty():
        return blocks.withColumn("_above", none), blocks.select("_tree", F.col("top").alias("_root"))
    sizes = blocks.groupBy("_tree").agg((F.max("_block") + 1).alias("_n"))
    sizes = stage(sizes, "merkle-sizes")
    tops = blocks.select("_tree", F.col("_block").alias("_i"), F.col("top").alias("_node")).join(sizes, "_tree")
    upper, roots = _tree_paths(tops, [])
    paths = stage(_members(upper, []).select("_tree", F.col("_i").alias("_block"), F.col("_path").alias("_above")), "merkle-paths")
    return blocks.join(paths, ["_tree", "_block"]), roots


def _members(blocks: DataFrame, payload: list[str]) -> DataFrame:
    """Rows of the blocks' members: _tree, the member's columns, and _path up to its tree's root."""

    def with_path(member, place):
        path = F.concat(_flanks(F.col("levels"), place), F.col("_above"))
        kept = [member[c].alias(c) for c in ("_i", "_node", *payload)]
        return F.struct(*kept, path.alias("_path"))

    return blocks.select("_tree", *_carried(blocks), F.inline(F.transform("_members", with_path)))


def _carried(blocks: DataFrame) -> list[str]:
    return [c for c in ("_root", "_top_path") if c in blocks.columns]


def merkle_manifest(df: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified.

    `df` has the columns of `documents`; others are ignored, whatever their
    names. `proof` lists the siblings from the leaf's level to the root, each as
    hex digests on the left and on the right of the node. Where `tampered`
    holds, folded_root is worked out from the leaf with 1 added to n_chars (a
    NULL, or the largest long, stays) and the original siblings.

    Languages are ordered bytewise, NULL first; within one, rows by doc_id, a
    NULL id first, rows of equal id by leaf. Rows that are alike in all fields
    have one leaf each; which of them takes which place makes no difference to
    the result. A language of one row has that leaf as subroot, and a table of
    one language that subroot as root; a proof without siblings is empty. An
    empty table gives no row.
    """
    of = {c: F.col(c) for c in FIELDS}
    largest = (1 << 63) - 1
    more = F.when(of["n_chars"] < largest, of["n_chars"].cast("long") + 1).otherwise(of["n_chars"])
    altered = leaf_digest([more if c == "n_chars" else of[c] for c in FIELDS])
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = df.select(
        of["lang"].alias("_lang"),
        of["doc_id"].alias("_id"),
        leaf_digest([of[c] for c in FIELDS]).alias("_node"),
        F.when(tampered, altered).alias("_altered"),
    )
    numbered = assign_ids(leaves, "_at", 0, ["_lang", "_id", "_node"])
    langs = numbered.groupBy("_lang").agg(F.min("_at").alias("_tree"), F.count("*").alias("_n"))
    langs = stage(langs.withColumnRenamed("_lang", "_of"), "merkle-groups")
    nodes = numbered.join(langs, F.col("_lang").eqNullSafe(F.col("_of"))).withColumn("_i", F.col("_at") - F.col("_tree"))
    blocks, roots = _tree_paths(nodes.select("_tree", "_i", "_n", "_node", "_id", "_altered"), ["_id", "_altered"])

    # The groups' trees are numbered by the place of their first leaf, so that order is the groups' own.
    ordered = assign_ids(stage(roots, "merkle-roots"), "_i", 0, ["_tree"])
    count = roots.count()
    forest = ordered.select(
        F.lit(0).alias("_tree"), "_i", F.lit(count).alias("_n"), F.col("_root").alias("_node"), F.col("_tree").alias("_own")
    )
    tops, root = _tree_paths(forest, ["_own"])
    last = root.first()
    above = _members(tops, ["_own"]).select(
        F.col("_own").alias("_tree"), F.col("_node").alias("_root"), F.col("_path").alias("_top_path")
    )
    joined = blocks.join(stage(above, "merkle-top-paths"), "_tree")
    rows = _members(joined, ["_id", "_altered"]).withColumn("_whole", F.concat("_path", "_top_path"))
    as_text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    root_text = F.lit(last["_root"].decode() if last else None).cast("string")
    folded = as_text(fold(F.coalesce("_altered", "_node"), F.col("_whole")))
    proof = F.transform(
        "_whole", lambda s: F.struct(s["left"].cast("string").alias("left"), s["right"].cast("string").alias("right"))
    )
    rows = rows.select(
        F.col("_id").alias("doc_id"),
        as_text("_node").alias("leaf"),
        as_text("_root").alias("subroot"),
        root_text.alias("root"),
        proof.alias("proof"),
        as_text(proof_digest(F.col("_whole"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def every_seventh(id_col: str = "doc_id") -> Column:
    """Whether 7 divides the crc32 of the decimal id; never for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % TAMPER_EVERY == 0


def _manifest_sql() -> str:
    def field(name: str, n_chars: str) -> str:
        text = f"CAST({n_chars if name == 'n_chars' else name} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(c, n_chars) for c in FIELDS) + ")"

    def tree(name: str, source: str) -> str:
        """All nodes: a node and its right neighbour become their hash, a last single node is hashed alone."""
        return f"""{name} AS (
            SELECT g, 0 AS lv, i, h, n FROM {source}
            UNION ALL
            SELECT g, lv + 1, i // 2, sha256(h || coalesce(r, '')), (n + 1) // 2
            FROM (SELECT *, lead(h) OVER (PARTITION BY g ORDER BY i) AS r FROM {name} WHERE n > 1) WHERE i % 2 = 0)"""

    def folded(name: str, source: str, nodes: str) -> str:
        """From (k, g, i, h, p), step by step to the top: h the node worked out, p the siblings passed."""
        return f"""{name} AS (
            SELECT k, g, 0 AS lv, i, h, p FROM {source}
            UNION ALL
            SELECT k, f.g, f.lv + 1, f.i // 2,
                   sha256(CASE WHEN f.i % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), p || coalesce(s.h, '')
            FROM {name} AS f JOIN {nodes} AS o ON o.g = f.g AND o.lv = f.lv AND o.i = f.i AND o.n > 1
            LEFT JOIN {nodes} AS s ON s.g = f.g AND s.lv = f.lv AND s.i = xor(f.i, 1))"""

    byte = "list_transform(range(1, length(s) + 1), lambda j: ascii(substr(s, j, 1))::BIGINT)"
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    crc = f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {byte}),
              lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {shift})))"""
    return f"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS k, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g,
               leaf AS h
        FROM (SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS s, {leaf('n_chars')} AS leaf, {leaf('n_chars + 1')} AS bad
              FROM documents)),
    {tree('t', 'd')},
    sub AS (SELECT 0 AS g, g AS i, h, count(*) OVER () AS n FROM t WHERE n = 1),
    {tree('u', 'sub')},
    low AS (SELECT k, g, i, CASE WHEN {crc} % {TAMPER_EVERY} = 0 THEN bad ELSE leaf END AS h, '' AS p FROM d),
    {folded('f', 'low', 't')},
    mid AS (SELECT f.k, 0 AS g, f.g AS i, f.h, f.p FROM f JOIN t ON t.g = f.g AND t.lv = f.lv AND t.n = 1),
    {folded('e', 'mid', 'u')},
    done AS (SELECT e.* FROM e JOIN u ON u.lv = e.lv AND u.n = 1),
    root AS (SELECT h FROM u WHERE n = 1)
    SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(done.p) AS proof_sha256, done.h AS folded_root,
           done.h = root.h AS verified
    FROM d JOIN sub ON sub.i = d.g JOIN done USING (k), root
    """


@query("op13_merkle_manifest", _manifest_sql())
def op13_merkle_manifest(spark, sf_dir):
    return merkle_manifest(table(spark, sf_dir, "documents"), every_seventh()).drop("proof")
