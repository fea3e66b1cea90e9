"""Merkle manifest of a table: one tree per group, one tree over the groups' roots.

A leaf is the digest of a row's fields. Within a group, leaves ascend by key and every
``ARITY`` consecutive nodes (the last run may be shorter) become their parent, level by
level, until one node is left; the roots of the groups, ordered by group, form a tree of
the same kind. Digests are lowercase hexadecimal SHA-256 texts, and the digest of several
is taken over their texts put together.

Between tasks digests travel as 32 bytes; they are texts only where they are hashed and returned.

Every level is one equi-join: each node asks for its siblings by their computed indices
(slot offsets within its run), and the nodes in slot zero emit the parents. Going back
down, a node's path (siblings to the left and to the right, level by level) is its own
siblings followed by the path of its parent, joined by ``(group, index div ARITY)``. No
join key repeats more than ``ARITY`` times, so a group that holds most rows is spread like
any other. Every level is written once to the shared folder.

NULL groups form a group of their own, before all others. NULL keys sort before others;
rows of equal key are ordered by leaf, and equal leaves may swap places. An empty table
gives an empty result; empty and very long texts are values like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked, stash

ARITY = 8
_MASK = (1 << 33) - 1
_PATH = "array<struct<left: binary, right: binary>>"
_TREE = ("gid", "idx", "h", "n", "left", "right")


def digest(*texts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the texts put together."""
    return F.sha2(F.concat(*texts), 256)


def as_text(digests: Column) -> Column:
    """One or more digests of 32 bytes as they are hashed and returned."""
    return F.lower(F.hex(digests))


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return digest(*[encoded(f) for f in fields])


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``idx``, the position from 0 within its ``grp``, and ``n``, the group's size.

    Rows are range-partitioned and sorted; a row's position is its place in its slab plus
    the rows of its group in earlier slabs. Only one row per (slab, group) is summed up.
    """
    keys = ["grp", *order]
    slabs = (nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys)
             .withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    slabs = stash(slabs, "slabs").withColumns({
        "_slab": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit(_MASK))})
    earlier = Window.partitionBy("grp").orderBy("_slab")
    sizes = slabs.groupBy("grp", "_slab").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")).select(
        F.col("grp").alias("_grp"), F.col("_slab").alias("_of"), "_first",
        F.coalesce(F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("grp")).alias("n"))
    placed = slabs.join(checked(stash(sizes, "sizes")), (F.col("_slab") == F.col("_of")) & F.col("grp").eqNullSafe(F.col("_grp")))
    return placed.select(*nodes.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("idx"), "n")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (gid, idx, h, n) with the digests of the other nodes of its run, put
    together in order: ``left`` of the node and ``right`` of it.

    Each node is joined to the nodes at its sibling indices; a node alone in its run has
    no siblings and two empty values. Further columns of ``nodes`` stay.
    """
    first = F.col("idx") - F.col("idx") % ARITY
    wanted = F.filter(F.sequence(first, F.least(first + (ARITY - 1), F.col("n") - 1)), lambda i: i != F.col("idx"))
    asks = nodes.select("gid", F.col("idx").alias("_of"), F.explode(wanted).alias("idx"))
    answers = asks.join(nodes.select("gid", "idx", "h"), ["gid", "idx"])
    sides = answers.groupBy("gid", F.col("_of").alias("idx")).agg(*[
        F.max(F.when(F.col("idx") % ARITY == slot, F.struct("idx", "h"))).alias(f"_s{slot}") for slot in range(ARITY)])
    slots = [F.col(f"_s{s}") for s in range(ARITY)]
    none = F.lit(b"")
    left = F.concat(*[F.coalesce(F.when(s["idx"] < F.col("idx"), s["h"]), none) for s in slots])
    right = F.concat(*[F.coalesce(F.when(s["idx"] > F.col("idx"), s["h"]), none) for s in slots])
    found = sides.select("gid", "idx", left.alias("left"), right.alias("right"))
    return nodes.join(found, ["gid", "idx"], "left").withColumns({
        "left": F.coalesce("left", none), "right": F.coalesce("right", none)})


def levels(nodes: DataFrame) -> list[DataFrame]:
    """All levels of the trees over ``nodes`` (gid, idx, h, n), lowest first, with siblings.

    The last level holds no node but roots; a root has ``n`` = 1.
    """
    out = []
    while True:
        level = stash(with_siblings(nodes), "level")
        out.append(level)
        if level.where("n > 1").isEmpty():
            return out
        parents = level.where((F.col("n") > 1) & (F.col("idx") % ARITY == 0))
        nodes = stash(parents.select("gid", F.expr(f"idx div {ARITY}").alias("idx"), F.unhex(digest(as_text(F.col("h")), as_text(F.col("right")))).alias("h"),
                                     F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n")), "parents")


def roots(tree: Sequence[DataFrame]) -> DataFrame:
    """``(gid, h)`` of every tree's root, lone leaves included."""
    found = [level.where("n = 1").select("gid", "h") for level in tree]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def paths(tree: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """``(gid, idx, h, path, ...)`` of the lowest level: siblings of a node and of all its
    ancestors, then the path and the further columns that ``tops`` has for its ``gid``.
    Further columns of the lowest level stay."""
    handed = [c for c in tops.columns if c not in ("gid", "path")]
    above = None
    for level in reversed(tree):
        extra = [c for c in level.columns if c not in _TREE] + handed
        done = level.where("n = 1").join(tops, "gid").select("gid", "idx", "h", "path", *extra)
        if above is not None:
            up = above.select("gid", F.col("idx").alias("_up"), F.col("path").alias("_path"), *handed)
            under = level.where("n > 1").withColumn("_up", F.expr(f"idx div {ARITY}")).join(up, ["gid", "_up"])
            own = F.array(F.struct("left", "right"))
            done = done.unionByName(under.select("gid", "idx", "h", F.concat(own, F.col("_path")).alias("path"), *extra))
        above = done if level is tree[0] else stash(done, "paths")
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (both as text) leads to with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda acc, step: digest(as_text(step["left"]), acc, as_text(step["right"])))


def manifest(rows: DataFrame, group: str, key: str, fields: Sequence[str], tampered: dict[str, Column] | None = None) -> DataFrame:
    """``(key, leaf, subroot, root, path, tampered_leaf)`` for every row of ``rows``; digests
    in paths are of 32 bytes each, the others texts.

    ``fields`` make up the leaf. ``path`` leads from the leaf to the root (see :func:`fold`).
    ``tampered_leaf`` is the leaf with some fields replaced by other expressions, which is
    how a changed row is tried against the manifest.
    """
    changed = tampered or {}
    leaves = stash(rows.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), F.unhex(leaf(*[F.col(f"`{f}`") for f in fields])).alias("h"),
        F.unhex(leaf(*[changed.get(f, F.col(f"`{f}`")) for f in fields])).alias("tampered")), "leaves")
    placed = stash(ranked(leaves, ["key", "h"]), "placed")
    # Groups are numbered in their order: the first tree's key, and the order of the second one's leaves.
    named = stash(ranked(placed.where("idx = 0").select(F.lit(0).alias("grp"), F.col("grp").alias("name")), ["name"]), "groups")
    names = checked(named.select(F.col("idx").alias("gid"), "name"))
    numbered = placed.join(names, F.col("grp").eqNullSafe(F.col("name")))
    nodes = stash(numbered.select("gid", "idx", "h", "n", "key", "tampered"), "nodes")
    tree = levels(nodes)
    subroots = stash(roots(tree).select(F.col("gid").alias("idx"), "h"), "subroots")
    count = subroots.count()
    top = levels(subroots.select(F.lit(0).cast("long").alias("gid"), "idx", "h", F.lit(count).cast("long").alias("n")))
    last = top[-1].where("n = 1").select("h").first()
    whole = F.lit(last[0].hex() if last else None).cast("string")
    start = top[0].sparkSession.range(1).select(F.lit(0).cast("long").alias("gid"), F.array().cast(_PATH).alias("path"))
    tops = paths(top, start).select(F.col("idx").alias("gid"), "path", F.col("h").alias("subroot"))
    found = paths(tree, stash(tops, "tops"))
    return found.select(F.col("key").alias(key), as_text(F.col("h")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"), whole.alias("root"),
                        "path", as_text(F.col("tampered")).alias("tampered_leaf"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: as_text(F.concat(step["left"], step["right"]))), ""), 256)


def verified(rows: DataFrame, key: str) -> DataFrame:
    """A manifest's rows with the digest of their proofs, folded from the tampered leaf."""
    folded = rows.withColumn("folded_root", fold(F.col("tampered_leaf"), F.col("path")))
    return folded.select(key, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
