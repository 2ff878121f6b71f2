"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups, a proof for every row.

A level of the tree is kept as one string of concatenated digests for each aligned block of 256 nodes.
Fixed-width substrings of a level are hashed to the level above; the substrings beside a node are the segments
of its proof. The roots of the blocks are the nodes of the next tier of blocks, until each group has one root;
the groups' roots, ordered by group, go through the same tiers once more. Blocks are aligned to a power of
two, so the tiers together are exactly the binary tree over the whole group: every two consecutive nodes have
a parent, a last single one is hashed alone.

A group may hold all rows: ranks come from a distributed sort (``running.offsets``), rows equal in all that is
hashed are one row with a count there, and no task holds more than its blocks. Everything is column expressions.

Defined results: a null group is one of its own and comes first; null keys come before all others; rows of one
key are ordered by their leaf digest; rows equal in all hashed columns are leaves of their own, next to each other.
A null field is ``-``. An empty table has no leaves and gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import written
from .running import copies, offsets

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a block: 2 to this power. A level of 256 digests is 16 KB.
BITS = 8


def field(value: Column) -> Column:
    """A field as it enters the leaf: ``-`` or its length in UTF-8 bytes, a colon, the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _level_above(level: str) -> str:
    """SQL of the level over ``level``, both binary: substrings of two digests (at the end one or two) are hashed."""
    return (
        f"cast(array_join(transform(sequence(0, (octet_length({level}) + 64) div 128 - 1), "
        f"i -> sha2(substring({level}, i * 128 + 1, 128), 256)), '') as binary)"
    )


#: Levels of a block from its nodes to its root; ``_depth`` of them are above the nodes.
_LEVELS = (
    f"aggregate(filter(sequence(1, {BITS}), i -> i <= _depth), array(_level), "
    "(levels, i) -> array_append(levels, " + _level_above("element_at(levels, -1)") + "))"
)
#: What stands beside node ``_node`` on each level: ``L`` or ``R`` and the digest, or nothing.
_BESIDE = (
    f"transform(filter(sequence(0, {BITS - 1}), i -> i < _depth), i -> "
    "case when shiftright(_node, i) & 1 = 1 "
    "then concat('L', cast(substring(_levels[i], (shiftright(_node, i) - 1) * 64 + 1, 64) as string)) "
    "when octet_length(_levels[i]) > (shiftright(_node, i) + 1) * 64 "
    "then concat('R', cast(substring(_levels[i], (shiftright(_node, i) + 1) * 64 + 1, 64) as string)) "
    "else '' end)"
)


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings on its path give."""

    def step(node: Column, beside: Column) -> Column:
        other = F.substring(beside, 2, 64)
        pair = F.when(beside.startswith("L"), F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(pair, 256)

    return F.aggregate(path, start, step)


def siblings(path: Column) -> Column:
    """All sibling digests of a path, bottom up, as one string."""
    return F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), "")


def climb(nodes: DataFrame, sizes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of blocks, each written once, over nodes ``(_group, _at, _hash, _item)``; and ``(_group, _root)``.

    ``_at`` counts a group's nodes from 0, ``sizes`` has their number as ``_size``; ``_item`` is kept with a node.
    """
    tiers = []
    last = sizes.agg(F.max("_size")).first()[0] or 1
    while True:
        tier = _blocks(nodes, sizes)
        tiers.append(tier)
        root = F.element_at("_levels", -1).cast("string")
        if last <= 1 << BITS:
            return tiers, tier.select("_group", root.alias("_root"))
        nodes = tier.select("_group", F.col("_block").alias("_at"), root.alias("_hash"), F.lit(None).cast("int").alias("_item"))
        up = (1 << BITS) - 1
        sizes, last = sizes.select("_group", F.shiftright(F.col("_size") + up, BITS).alias("_size")), (last + up) >> BITS


def _blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    sorted_nodes = F.array_sort(F.collect_list(F.struct("_at", "_hash", "_item")))
    blocks = nodes.groupBy("_group", F.shiftright("_at", BITS).alias("_block")).agg(sorted_nodes.alias("_nodes"))
    level = F.array_join(F.transform("_nodes", lambda n: n["_hash"]), "").cast("binary")
    # Levels above the nodes: as many as halvings until one node of the group is left, a whole block's at most.
    depth = F.when(F.col("_size") > 1, F.length(F.bin(F.col("_size") - 1))).otherwise(0)
    blocks = blocks.join(sizes, "_group").select(
        "_group",
        "_block",
        F.least(depth, F.lit(BITS)).alias("_depth"),
        level.alias("_level"),
        F.transform("_nodes", lambda n: n["_item"]).alias("_items"),
    )
    return written(blocks.select("_group", "_block", "_depth", "_items", F.expr(_LEVELS).alias("_levels")), "blocks")


def descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every node of the lowest tier with its path: ``(_group, _at, _hash, _item, _path, ...)``.

    ``above`` has ``(_group, _above, ...)``: the siblings over each group's root; its other columns are handed down.
    """
    handed = [c for c in above.columns if c not in ("_group", "_above")]
    above = above.withColumn("_block", F.lit(0).cast("bigint"))
    for tier in reversed(tiers):
        nodes = tier.join(above, ["_group", "_block"]).select("*", F.posexplode("_items").alias("_node", "_item"))
        path = F.concat(F.expr(_BESIDE), F.col("_above"))
        at = F.shiftleft("_block", BITS) + F.col("_node")
        digest = F.expr("cast(substring(_levels[0], _node * 64 + 1, 64) as string)")
        nodes = nodes.select("_group", at.alias("_at"), digest.alias("_hash"), "_item", path.alias("_path"), *handed)
        above = nodes.select("_group", F.col("_at").alias("_block"), F.col("_path").alias("_above"), *handed)
    return nodes


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
    changed: dict[str, Column] | None = None, when: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, path, found (the leaf as it is found now).

    ``path`` has a row's siblings bottom up: side and digest, or nothing where a node has none. ``changed`` gives
    fields other values in the rows where ``when`` holds: what is found there in a later look at the data.
    """
    values = [F.col(f) for f in fields]
    later = [(changed or {}).get(f, F.col(f)) for f in fields]
    found = F.when(when, leaf(later)) if changed and when is not None else F.lit(None).cast("string")
    # '-' sorts before '=': the null group comes first.
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    rows = docs.select(name.alias("_group"), F.col(key).alias("_key"), leaf(values).alias("_leaf"), found.alias("_found"))
    rows = rows.groupBy("_group", "_key", "_leaf", "_found").agg(F.count("*").alias("_n"))
    rows = offsets(rows, "_group", ["_key", "_leaf"], F.col("_n"), "_at")
    sizes = written(rows.groupBy("_group").agg(F.sum("_n").alias("_size")), "group-sizes")
    item = F.struct("_key", "_found")
    nodes = copies(rows, "_n", "_at").select("_group", "_at", F.col("_leaf").alias("_hash"), item.alias("_item"))
    tiers, roots = climb(nodes, sizes)

    top = offsets(roots.select(F.lit("").alias("_all"), "_group", "_root"), "_all", ["_group"], F.lit(1), "_at")
    top = top.select(F.col("_all").alias("_group"), "_at", F.col("_root").alias("_hash"), F.col("_group").alias("_item"))
    top_tiers, top_roots = climb(top, written(top.groupBy("_group").agg(F.count("*").alias("_size")), "group-count"))
    start = top_roots.select("_group", F.array().cast("array<string>").alias("_above"), "_root")
    groups = descend(top_tiers, start).select(
        F.col("_item").alias("_group"), F.col("_path").alias("_above"), F.col("_hash").alias("_subroot"), "_root"
    )
    leaves = descend(tiers, written(groups, "groups"))
    return leaves.select(
        F.col("_item._key").alias(key),
        F.col("_hash").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        F.col("_path").alias("path"),
        F.coalesce("_item._found", "_hash").alias("found"),
    )


def verified(leaves: DataFrame, key: str = "doc_id") -> DataFrame:
    """``manifest`` with digests for the paths: does the leaf found now lead to the root?"""
    refolded = folded(F.col("found"), F.col("path"))
    rows = leaves.select(key, "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), refolded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
