"""Merkle manifest of a table: one hash tree a group, one tree over the groups' roots, a proof for every row.

Concatenated-level strings: rows are numbered within their group and dealt to aligned blocks of
``fanout ** block_levels`` leaves. A block keeps each level of its subtree as one string of hex digests,
64 characters a node, so a parent is the hash of a fixed-width substring and the siblings of a node are the
substrings that flank it. Block roots are the leaves of the next tree of blocks, until one block a group is
left; the groups' roots go the same way. Proofs come down again: a block's rows get their own siblings
followed by those of the block. Everything is SQL functions; a task holds a block at a time, whatever the size of a group.

While a level has several nodes, every ``fanout`` consecutive ones become their hash; a last run may be
shorter, even one node. A single leaf is its tree's root.

Defined results: a null group is a group of its own, before all others; null values of the order come
first; rows equal in group and order stand by their hashes, so repeated rows have the same leaf and proofs of
their own; empty and very long values are hashed whole; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions.variants import once
from tickspark.llm.graph import stored
from tickspark.operators.numbering import numbered

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 10
_HEX = 64


def leaf_of(columns: list[str | Column]) -> Column:
    """Hash of a row: of each value ``-`` if null, else its UTF-8 bytes' count, a colon and the value."""
    parts = []
    for c in columns:
        text = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _slice(level: Column, first: Column, nodes: Column | int) -> Column:
    """Digests of a level's nodes from the first on; as bytes, whose place is known without a search."""
    return F.substring(level.cast("binary"), first * _HEX + 1, nodes * _HEX).cast("string")


def _parents(level: Column, fanout: int) -> Column:
    runs = F.ceil(F.octet_length(level) / (_HEX * fanout)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_slice(level, i * fanout, F.lit(fanout)), 256)), "")


class _Forest:
    """Blocks of trees, from the leaves up: tables (tree, block, depth, entries); the last has one block a tree.

    nodes: (tree, number, total, hash, row)."""

    def __init__(self, nodes: DataFrame, fanout: int, block_levels: int):
        self.fanout, self.size, self.most = fanout, fanout**block_levels, block_levels
        self.tables: list[DataFrame] = []
        while True:
            block = F.floor(F.col("number") / self.size)
            entries = F.array_sort(F.collect_list(F.struct("number", "hash", "row")))
            # Levels above the leaves that the block takes part in: all, unless the tree ends within it.
            depth = sum(((F.max("total") > fanout**t).cast("int") for t in range(block_levels)), F.lit(0))
            blocks = stored(nodes.groupBy("tree", block.alias("block")).agg(entries.alias("entries"), depth.alias("depth"), F.max("total").alias("total")))
            self.tables.append(blocks)
            if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
                break
            total = F.ceil(F.col("total") / self.size).cast("long")
            nodes = self._levels(blocks).select("tree", F.col("block").alias("number"), total.alias("total"), F.element_at("levels", -1).alias("hash"), F.lit(None).cast("string").alias("row"))

    def _levels(self, blocks: DataFrame) -> DataFrame:
        leaves = F.array_join(F.transform("entries", lambda e: e["hash"]), "")
        levels = F.aggregate(F.array_repeat(F.lit(0), F.col("depth")), F.array(leaves), lambda a, _: F.concat(a, F.array(_parents(F.element_at(a, -1), self.fanout))))
        return once(blocks, blocks.columns, levels=levels)

    def roots(self) -> DataFrame:
        """(tree, root)"""
        return self._levels(self.tables[-1]).select("tree", F.element_at("levels", -1).alias("root"))

    def paths(self, above: DataFrame) -> DataFrame:
        """(row, steps, ...) of every leaf; above: (tree, steps, ...), what is to stand over each tree."""
        others = [c for c in above.columns if c not in ("tree", "steps")]
        above = above.withColumn("block", F.lit(0).cast("long"))
        for at in range(len(self.tables) - 1, -1, -1):
            blocks = self._levels(self.tables[at]).join(above, ["tree", "block"])

            def with_path(e: Column) -> Column:
                place = e["number"] % self.size

                def step(level: Column, t: Column) -> Column:
                    here = F.floor(place / F.pow(F.lit(self.fanout), t)).cast("int")
                    first = here - here % self.fanout
                    return F.struct(_slice(level, first, here - first).alias("left"), _slice(level, here + 1, first + self.fanout - here - 1).alias("right"))

                own = F.transform(F.slice("levels", F.lit(1), F.col("depth")), step)
                return F.struct(e["number"].alias("number"), e["row"].alias("row"), F.concat(own, F.col("steps")).alias("steps"))

            rows = blocks.select("tree", *others, F.explode(F.transform("entries", with_path)).alias("e"))
            above = rows.select("tree", *others, F.col("e.number").alias("block"), F.col("e.steps").alias("steps"), F.col("e.row").alias("row"))
            if at:
                above = above.drop("row")
        return above.select("row", "steps", *others)


def proofs(leaves: DataFrame, group: str = "lang", order: str = "doc_id", *, hash_col: str = "leaf", fanout: int = 2, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The leaves' rows with ``subroot`` (of their group), ``root`` and ``steps``: siblings to the left and to the right, from the leaf up.

    Columns of leaves must have an order (no maps), as a block's rows are sorted."""
    name = F.col(f"`{group}`").cast("string")
    tree = F.coalesce(F.concat(F.lit("="), name), F.lit(""))  # in order of bytes, null first
    rows = leaves.select(tree.alias("tree"), F.col(f"`{order}`").alias("at"), F.col(f"`{hash_col}`").alias("hash"), F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("row"))
    groups = _Forest(numbered(rows, ["tree"], ["at", "hash"], total="total"), fanout, block_levels)
    roots = stored(groups.roots())
    nodes = numbered(roots.select("tree", F.col("root").alias("hash")), [], ["tree"], total="total")
    top = _Forest(nodes.select(F.lit("").alias("tree"), "number", "total", "hash", F.struct("tree", F.col("hash").alias("subroot")).alias("row")), fanout, block_levels)
    none = F.array().cast("array<struct<left:string,right:string>>")
    over = top.paths(top.roots().withColumn("steps", none))
    return groups.paths(over.select("row.tree", "row.subroot", "root", "steps")).select("row.*", "subroot", "root", "steps")


def siblings(steps: Column) -> Column:
    """The digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))
