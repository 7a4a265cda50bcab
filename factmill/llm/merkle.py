"""Merkle manifest of a dataset: a hash tree per group, and one over the groups' roots.

Leaves are hashed natively, put in order by a range shuffle and gathered in blocks of
``2 ** LEVELS`` consecutive ones. Higher-order functions collapse a block's array level by
level (sequence, transform, slice, aggregate); the blocks' roots are nodes of the next
step, and so on until each group has one. All nodes of a group but its last run have two
children, so a block collapses like any other part of the tree, however many there are: a
step leaves 1 node of 256, and a group of any size is spread over as many blocks.

A row's proof is its block's siblings, then those of the block among the blocks, up to the
root; the upper paths are joined by block, not by row. The scratch tables hold digests only.

Defined results: nulls of any column are hashed as nulls; rows of one null group are a group,
which comes first; a null order key comes first; rows equal in group and key follow their
leaves' digests, and fully equal rows are interchangeable; an empty table gives no rows; columns
that aren't named stay out, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factmill.llm.scratch import Scratch, small

LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value as text, so that no two rows read alike."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row."""
    return digest(*[field(v) for v in values])


def _above(nodes: Column) -> Column:
    """The digests of every two consecutive nodes."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), lambda i: digest(F.array_join(F.slice(nodes, i * 2 + 1, 2), "")))


def _levels(nodes: Column, n: Column) -> Column:
    """The nodes and the n levels above them, as arrays."""
    steps = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.array(nodes), lambda found, _: F.concat(found, F.array(_above(F.element_at(found, -1)))))


def _siblings(levels: Column, at: Column) -> Column:
    """The sibling on each level but the highest of the node at this index; null where a run has one node."""
    below = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.transform(below, lambda nodes, up: F.get(nodes, F.call_function("shiftright", at, up).bitwiseXOR(F.lit(1))))


def folded(node: Column, at: Column, siblings: Column) -> Column:
    """The root that a node at this index of its tree leads to with these siblings."""
    start = F.struct(node.alias("h"), at.cast("long").alias("at"))

    def up(found: Column, sibling: Column) -> Column:
        own, even = found["h"], found["at"] % 2 == 0
        both = F.when(sibling.isNull(), digest(own)).when(even, digest(own, sibling)).otherwise(digest(sibling, own))
        return F.struct(both.alias("h"), F.shiftright(found["at"], 1).alias("at"))

    return F.aggregate(siblings, start, up, lambda found: found["h"])


def proof_digest(siblings: Column) -> Column:
    """The digest of all siblings that there are, from the leaf up."""
    return digest(F.array_join(siblings, ""))


def _positioned(scratch: Scratch, rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """rows with pos: the row's rank from 0 within its group, by order. A range shuffle puts them in order; equal rows are dealt like others."""
    ranged = rows.withColumn("__row", F.monotonically_increasing_id())
    keys = [group, *order, "__row"]
    ranged = ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()).drop("__row")
    ranged = scratch.table(ranged.withColumn("__part", F.shiftright("__at", 33)), name)
    parts = ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = scratch.table(parts.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), (before - F.col("__first")).alias("__shift")), f"{name}-parts")
    on = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p"))
    return ranged.join(small(parts, parts.count()), on).withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__g", "__p", "__shift")


def _blocks(scratch: Scratch, nodes: DataFrame, group: str, carried: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """group, block, depth (levels to collapse), items (struct of pos, node and what is carried, in order); and the depth of the deepest group."""
    sizes = nodes.groupBy(F.col(group).alias("__g")).agg(F.max("pos").alias("__last"))
    depth = F.when(F.col("__last") > 0, F.length(F.bin("__last"))).otherwise(0)
    sizes = scratch.table(sizes.select("__g", depth.alias("__depth")), f"{name}-depths")
    deepest = sizes.agg(F.max("__depth")).first()[0] or 0
    blocks = nodes.groupBy(group, F.shiftright("pos", LEVELS).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "node", *carried))).alias("items"))
    blocks = blocks.join(small(sizes, sizes.count()), F.col(group).eqNullSafe(F.col("__g")))
    return scratch.table(blocks.select(group, "block", F.least(F.lit(LEVELS), "__depth").alias("depth"), "items"), name), deepest


def _tree(scratch: Scratch, nodes: DataFrame, group: str, carried: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Roots (group, root) and, for each of nodes (group, pos, node, carried), its siblings up to its group's root."""
    blocks, deepest = _blocks(scratch, nodes, group, carried, name)
    nodes_of = F.transform("items", lambda x: x["node"])
    leveled = blocks.withColumn("levels", _levels(nodes_of, F.col("depth")))
    tops = leveled.select(group, F.col("block").alias("pos"), F.get(F.element_at("levels", -1), F.lit(0)).alias("node"))
    if deepest <= LEVELS:
        roots = scratch.table(tops.select(group, F.col("node").alias("root")), f"{name}-roots")
        leveled = leveled.withColumn("above", F.array().cast("array<string>"))
    else:
        roots, paths = _tree(scratch, scratch.table(tops, f"{name}-tops"), group, [], f"{name}+")
        paths = scratch.table(paths.select(F.col(group).alias("__g"), F.col("pos").alias("__b"), F.col("siblings").alias("above")), f"{name}-paths")
        on = F.col(group).eqNullSafe(F.col("__g")) & (F.col("block") == F.col("__b"))
        leveled = leveled.join(small(paths, paths.count() * LEVELS * 4), on).drop("__g", "__b")
    # the siblings are read off within the block's row: exploded rows don't carry its levels
    first = F.shiftleft("block", LEVELS)
    found = F.transform("items", lambda x: F.struct(x.alias("x"), F.concat(_siblings(F.col("levels"), (x["pos"] - first).cast("int")), F.col("above")).alias("siblings")))
    rows = leveled.select(group, F.explode(found).alias("f")).select(group, *[F.col(f"f.x.{c}").alias(c) for c in ("pos", "node", *carried)], "f.siblings")
    return roots, rows


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """key, group, leaf, pos, siblings (to subroot), subroot, group_pos, group_siblings (to root), root and the columns of ``carry``.

    Leaves are digests of ``fields``; each value of ``group`` has a tree of its rows by ascending
    ``key``, whose root is subroot; the groups' subroots, by ascending group, have the tree of root.
    """
    scratch, carried = Scratch(rows.sparkSession, "merkle"), dict(carry or {})
    leaves = rows.select(F.col(group).alias("__group"), F.col(key).alias("__key"), leaf([F.col(f) for f in fields]).alias("node"), *[c.alias(n) for n, c in carried.items()])
    leaves = scratch.table(leaves, "leaves")
    nodes = _positioned(scratch, leaves, "__group", ["__key", "node"], "ordered")
    subroots, found = _tree(scratch, nodes, "__group", ["__key", *carried], "blocks")
    scratch.drop("leaves", "ordered")
    tops = subroots.select(F.lit(0).alias("one"), "__group", F.col("root").alias("node"))
    roots, groups = _tree(scratch, _positioned(scratch, tops, "one", ["__group"], "groups"), "one", ["__group"], "top")
    groups = groups.select(F.col("__group").alias("__g"), F.col("node").alias("subroot"), F.col("pos").alias("group_pos"), F.col("siblings").alias("group_siblings"), "one").join(F.broadcast(roots), "one").drop("one")
    groups = scratch.table(groups, "roots")
    found = found.join(small(groups, groups.count() * 8), F.col("__group").eqNullSafe(F.col("__g")))
    return found.select(F.col("__key").alias(key), F.col("__group").alias(group), F.col("node").alias("leaf"), "pos", "siblings", "subroot", "group_pos", "group_siblings", "root", *carried)


def root_of(node: Column) -> Column:
    """The root that a manifest's row leads to when ``node`` stands for its leaf."""
    return folded(folded(node, F.col("pos"), F.col("siblings")), F.col("group_pos"), F.col("group_siblings"))


def op13(docs: DataFrame) -> DataFrame:
    """The contract's columns: each row's proof, folded from a leaf that adds 1 to n_chars where 7 divides the CRC of doc_id.

    A null doc_id isn't tampered with; a null n_chars stays null, so its leaf does too.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    values = [F.col(f) if f != "n_chars" else F.col(f) + 1 for f in FIELDS]
    rows = manifest(docs, carry={"tampered": F.when(changed, leaf(values))})
    rows = rows.withColumn("folded_root", root_of(F.coalesce("tampered", "leaf")))
    proof = proof_digest(F.concat("siblings", "group_siblings"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "lang")
