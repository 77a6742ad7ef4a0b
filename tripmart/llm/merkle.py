"""Merkle manifest of a table, built by appending to aligned blocks with incremental witnesses.

Rows of a group are numbered in order and dealt to aligned blocks of 2**k positions. A task appends the
leaves of a block one by one to a frontier of open subtrees: each leaf holds the witness of the subtree
that it lies in, and when a subtree meets its sibling, the witnesses of both sides grow by the other's
root. Block roots are appended in the same way as the leaves of the next round, until every group has
one node; the groups' roots are appended once more. Going back down, a witness is continued by that of
its block. At the end of a row of nodes one without a sibling is hashed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import join_same, numbered, stored

BLOCK_LEVELS = 12  # 4096 leaves in a block


def node_hash(*children: str) -> str:
    return hashlib.sha256("".join(children).encode("ascii")).hexdigest()


class Frontier:
    """An append-only binary tree: open subtrees from left to right, and the witness of every leaf.

    A witness has an entry for each level above the leaf so far: ``<`` and the sibling's root if that is
    on the left, ``>`` and the root if it is on the right, or nothing for a node hashed alone.
    ``opened`` continues a tree whose subtrees (level, root) are known while their leaves are elsewhere.
    """

    def __init__(self, opened: Sequence[tuple[int, str]] = ()):
        self.witnesses: list[list[str]] = []
        self.open = [(level, root, 0, 0) for level, root in opened]

    def state(self) -> list[tuple[int, str]]:
        return [(level, root) for level, root, _, _ in self.open]

    def _extend(self, first: int, end: int, entry: str) -> None:
        for witness in self.witnesses[first:end]:
            witness.append(entry)

    def _push(self, level: int, root: str, first: int, end: int) -> None:
        while self.open and self.open[-1][0] == level:
            _, left, start, middle = self.open.pop()
            self._extend(start, middle, ">" + root)
            self._extend(first, end, "<" + left)
            level, root, first = level + 1, node_hash(left, root), start
        self.open.append((level, root, first, end))

    def append(self, leaf: str) -> None:
        self.witnesses.append([])
        self._push(0, leaf, len(self.witnesses) - 1, len(self.witnesses))

    def close(self, levels: int = 0) -> str:
        """The root; ends the tree. ``levels`` is the least height, reached by hashing nodes alone."""
        while len(self.open) > 1 or self.open[0][0] < levels:
            level, root, first, end = self.open.pop()
            self._extend(first, end, "")
            self._push(level + 1, node_hash(root), first, end)
        return self.open[0][1]


def _block_builder(levels: int) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        tree = Frontier()
        for node in table.column("node").to_pylist():
            tree.append(node)
        more = table.column("n")[0].as_py() > 1 << levels
        root = tree.close(levels if more else 0)
        table = table.append_column("witness", pa.array(tree.witnesses, pa.list_(pa.string())))
        return table.append_column("block_root", pa.array([root] * len(table), pa.string()))

    return build


def _appended(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (tree, place, n, node, ...) with their witness within, and the root of, their block."""
    blocked = nodes.withColumn("block", F.shiftright("place", levels))
    schema = T.StructType([*blocked.schema.fields, T.StructField("witness", T.ArrayType(T.StringType())), T.StructField("block_root", T.StringType())])
    return blocked.groupBy("tree", "block").applyInArrow(_block_builder(levels), schema)


def witnessed(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Witnesses of all nodes, and the root of every tree.

    ``nodes``: tree (long), place (0 to n - 1 within the tree), n, node (hex) and others, which stay.
    Returns (nodes with ``witness``, (tree, root)). Rounds go on while any tree has over one node; a
    round has 2**levels times fewer nodes than the one before.
    """
    rounds = []
    while True:
        rounds.append(stored(_appended(nodes, levels), "merkle-round"))
        size = 1 << levels
        nodes = rounds[-1].filter(F.col("place") % size == 0).select(
            "tree", F.col("block").alias("place"),
            F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("block_root").alias("node"))
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            break
    above = None
    for part in reversed(rounds):
        if above is not None:
            path = above.select("tree", F.col("place").alias("block"), F.col("witness").alias("path"))
            part = part.join(path, ["tree", "block"]).withColumn("witness", F.concat("witness", "path")).drop("path")
        above = part
    return above.drop("block", "block_root"), nodes.select("tree", F.col("node").alias("root"))


def folded(start: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    sibling = lambda x: F.substring(x, 2, 64)
    return F.aggregate(
        witness, start,
        lambda node, x: F.sha2(
            F.when(x == "", node).when(x.startswith("<"), F.concat(sibling(x), node)).otherwise(F.concat(node, sibling(x))), 256))


def proof_digest(witness: Column) -> Column:
    """Hash of the siblings from the leaf up."""
    siblings = F.transform(F.filter(witness, lambda x: x != ""), lambda x: F.substring(x, 2, 64))
    return F.sha2(F.array_join(siblings, ""), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def manifest(
    docs: DataFrame,
    *,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    order_col: str = "doc_id",
    changed: dict[str, Column] | None = None,
    carry: Sequence[str] = (),
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Leaf, roots and witness of every row.

    A row's leaf hashes ``fields`` in order. Each group is a tree of its leaves in ascending order, null
    first; rows with equal order values stand by leaf, so equal rows may swap places and nothing else
    depends on chance. The groups' roots, null first and by UTF-8 bytes, are the leaves of the last tree.
    Returns the columns ``carry``, ``leaf``, ``other_leaf`` (with the expressions in ``changed`` instead of
    those fields; null without), ``subroot``, ``root`` and ``witness``. Nulls are values of their own;
    other columns are not read; an empty table gives no rows.
    """
    changed = changed or {}
    value = {c: F.col(c) for c in fields}
    other = leaf_hash(*[changed.get(c, value[c]) for c in fields]) if changed else F.lit(None).cast("string")
    leaves = docs.select(
        F.col(group_col).cast("string").alias("group"), F.col(order_col).alias("place_by"), leaf_hash(*value.values()).alias("leaf"),
        other.alias("other_leaf"), F.struct(*[F.col(c) for c in carry], F.lit(0).alias("_")).alias("carried"))
    first = [F.asc_nulls_first("group"), F.asc_nulls_first("place_by"), F.asc("leaf")]
    lined = numbered(leaves, first, "number").drop("place_by")
    groups = lined.groupBy("group").agg(F.min("number").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = stored(numbered(groups, [F.asc_nulls_first("group")], "tree"), "merkle-groups")
    count = trees.count()
    known = F.broadcast(trees) if count <= 100_000 else trees
    placed = join_same(lined, known, ["group"]).select(
        "tree", (F.col("number") - F.col("start")).alias("place"), "n", F.col("leaf").alias("node"), "other_leaf", "carried")
    rows, subroots = witnessed(placed, levels)
    last = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(count).cast("long").alias("n"), F.col("root").alias("node"))
    tops, roots = witnessed(last, levels)
    root = roots.first()
    ends = tops.select(F.col("place").alias("tree"), F.col("node").alias("subroot"), F.col("witness").alias("top"))
    if count <= 100_000:
        ends = F.broadcast(ends)
    return rows.join(ends, "tree").select(
        *[F.col(f"carried.{c}").alias(c) for c in carry], F.col("node").alias("leaf"), "other_leaf", "subroot",
        F.lit(root and root.root).cast("string").alias("root"), F.concat("witness", "top").alias("witness"))


def tampered_documents(docs: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of documents with a check of tampered ones, whose ``n_chars`` has grown by one.

    Tampered are the rows with a crc32 of the decimal id that 7 divides; a null id or count changes
    nothing. The folded root comes from the tampered leaf and the witness of the original one.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    grown = F.when(F.coalesce(hit, F.lit(False)), F.try_add("n_chars", F.lit(1).cast("long"))).otherwise(F.col("n_chars"))
    rows = manifest(docs, changed={"n_chars": grown}, carry=["doc_id"], levels=levels)
    fold = rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"),
        folded(F.col("other_leaf"), F.col("witness")).alias("folded_root"))
    return fold.withColumn("verified", F.col("folded_root") == F.col("root"))
