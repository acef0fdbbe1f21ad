"""Merkle manifest of a dataset, its trees stored in van Emde Boas blocks.

Every row is a leaf; the leaves of a group, by id, are the leaves of its tree,
and the roots of the groups are the leaves of one more tree.  A tree is cut into
aligned subtrees of ``BLOCK_HEIGHT`` levels of hashing, the blocks; the roots of
the blocks are the leaves of the next level of blocks, until one block is left.
A block is one array of digests in van Emde Boas order: the upper half of its
levels first, then each subtree of the lower half, both laid out in the same way.
A node's address follows from its depth and index alone, in construction as in
the retrieval of siblings, so no pointers are stored.

Places of leaves come from distributed sorts; a block is one group of bounded
size, and a group of any size has as many blocks as it needs.  Proofs are
completed from the top: each block takes the path of its own root and hands to
its leaves theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.llm.ranks import numbered

ARITY = 8
BLOCK_HEIGHT = 4
DIGEST = 32
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def tree_size(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def veb_address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Addresses of the nodes ``index`` at ``depth`` (0: root) in a complete tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return veb_address(top, depth, index)
    width = ARITY ** (depth - top)
    inside = veb_address(levels - top, depth - top, index % width)
    return tree_size(top) + index // width * tree_size(levels - top) + inside


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def height_of(leaves: int) -> int:
    """Levels of hashing until one node remains."""
    height = 0
    while ARITY ** height < leaves:
        height += 1
    return height


class Block:
    """An aligned subtree: ``count`` leaves at depth ``height``, digests in van Emde Boas order."""

    def __init__(self, height: int, count: int, nodes: np.ndarray):
        self.height, self.count, self.nodes = height, count, nodes

    @classmethod
    def build(cls, height: int, leaves: list[str]) -> Block:
        block = cls(height, len(leaves), np.zeros((tree_size(height + 1), DIGEST), np.uint8))
        raw = np.frombuffer(bytes.fromhex("".join(leaves)), np.uint8).reshape(-1, DIGEST)
        block.nodes[block.address(height, np.arange(len(leaves)))] = raw
        for depth in range(height - 1, -1, -1):
            below = block.level(depth + 1)
            width = 2 * DIGEST * ARITY
            digests = [hashlib.sha256(below[at:at + width].encode("ascii")).digest() for at in range(0, len(below), width)]
            at = block.address(depth, np.arange(len(digests)))
            block.nodes[at] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)
        return block

    @classmethod
    def load(cls, height: int, count: int, nodes: bytes) -> Block:
        return cls(height, count, np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST))

    def address(self, depth: int, index: np.ndarray) -> np.ndarray:
        return veb_address(self.height + 1, depth, index)

    def nodes_at(self, depth: int) -> int:
        """Nodes in use at a depth: a parent for every run of eight or fewer."""
        width = ARITY ** (self.height - depth)
        return (self.count + width - 1) // width

    def level(self, depth: int) -> str:
        """All digests of a depth, one after the other."""
        return self.nodes[self.address(depth, np.arange(self.nodes_at(depth)))].tobytes().hex()

    def root(self) -> str:
        return self.nodes[0].tobytes().hex()

    def siblings(self, leaf: int) -> Iterator[tuple[str, str]]:
        """From the leaf up: the digests of its run before and behind the node on its path."""
        for depth in range(self.height, 0, -1):
            index = leaf // ARITY ** (self.height - depth)
            first = index - index % ARITY
            last = min(first + ARITY, self.nodes_at(depth))
            run = self.nodes[self.address(depth, np.arange(first, last))].tobytes().hex()
            cut_at = 2 * DIGEST * (index - first)
            yield run[:cut_at], run[cut_at + 2 * DIGEST:]


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself as text."""
    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns.values()]).cast("binary"), 256)


@dataclass
class Forest:
    """Trees as block tables, one for each level of blocks from the leaves up.

    A block row is ``(tree, block, leaves, height, count, nodes, root)``:
    ``leaves`` are those of the tree at this level of blocks.
    """
    levels: list[DataFrame]
    block_height: int

    def tops(self) -> list[DataFrame]:
        """The block that holds a tree's root, of all trees, by level."""
        return [level.where(F.col("leaves") <= ARITY ** self.block_height) for level in self.levels]

    def roots(self) -> DataFrame:
        """``(tree, root)`` of every tree."""
        out = None
        for top in self.tops():
            top = top.select("tree", "root")
            out = top if out is None else out.unionByName(top)
        return out

    def write(self, path: str) -> None:
        """Write the blocks as a Parquet table ``path``, partitioned by level."""
        for k, level in enumerate(self.levels):
            level.write.mode("overwrite").parquet(f"{path.rstrip('/')}/level={k}")


def build_forest(leaves: DataFrame, block_height: int = BLOCK_HEIGHT) -> Forest:
    """Blocks of all trees of ``leaves(tree, leaves, place, digest)``.

    ``leaves`` is the number of the tree's leaves, ``place`` a leaf's place from
    0, ``digest`` hexadecimal.  A level of blocks is one grouped job; the number
    of levels is the logarithm of the largest tree to base 8 ** block_height.
    """
    size = ARITY ** block_height
    schema = "tree long, block long, leaves long, height int, count int, nodes binary, root string"

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        leaves = int(group["leaves"].iloc[0])
        height = block_height if leaves > size else height_of(leaves)
        block = Block.build(height, group["digest"].tolist())
        return pd.DataFrame({"tree": group["tree"].iloc[:1], "block": group["block"].iloc[:1], "leaves": leaves, "height": height,
                             "count": block.count, "nodes": [block.nodes.tobytes()], "root": block.root()})

    levels = []
    while True:
        blocked = leaves.select("tree", "leaves", "place", "digest", F.expr(f"place div {size}").alias("block"))
        level = cut(blocked.groupBy("tree", "block").applyInPandas(build, schema))
        levels.append(level)
        more = level.where(F.col("leaves") > size)
        if more.isEmpty():
            return Forest(levels, block_height)
        leaves = more.select("tree", F.expr(f"(leaves + {size - 1}) div {size}").alias("leaves"), F.col("block").alias("place"),
                             F.col("root").alias("digest"))


PATH = "left array<string>, right array<string>"


def _paths(blocks: DataFrame) -> DataFrame:
    """``(tree, place, left, right)`` of every leaf of ``blocks(.., left, right)``, whose own paths go on upwards."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in group.itertuples():
            block = Block.load(b.height, b.count, b.nodes)
            first = b.block * ARITY ** b.height
            for leaf in range(b.count):
                steps = list(block.siblings(leaf))
                out.append((b.tree, first + leaf, [s[0] for s in steps] + list(b.left), [s[1] for s in steps] + list(b.right)))
        return pd.DataFrame(out, columns=["tree", "place", "left", "right"])

    return blocks.groupBy("tree", "block").applyInPandas(run, f"tree long, place long, {PATH}")


def block_paths(forest: Forest, above: DataFrame) -> DataFrame:
    """The lowest blocks with the paths from their roots up.

    ``above(tree, left, right, ..)`` has the path from each tree's root on, and
    any columns to hand down.  Goes down one level of blocks at a time.
    """
    extra = [c for c in above.columns if c not in ("tree", "left", "right")]
    named = above.select(F.col("tree").alias("t"), "left", "right", *extra)
    below = None
    for k in range(len(forest.levels) - 1, -1, -1):
        size = F.lit(ARITY ** forest.block_height)
        blocks = forest.tops()[k].join(named, F.col("tree") == F.col("t")).drop("t")
        if below is not None:
            inner = forest.levels[k].where(F.col("leaves") > size)
            blocks = blocks.unionByName(inner.join(below, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("p"))).drop("t", "p"))
        if k == 0:
            return blocks
        blocks = cut(blocks)
        handed = blocks.select(F.col("tree").alias("e"), F.col("block").alias("eb"), *extra)
        paths = _paths(blocks).withColumn("eb", F.expr(f"place div {ARITY ** forest.block_height}"))
        below = paths.join(handed.withColumnRenamed("eb", "hb"), (F.col("tree") == F.col("e")) & (F.col("eb") == F.col("hb"))).select(
            F.col("tree").alias("t"), F.col("place").alias("p"), "left", "right", *extra)
    raise AssertionError("a forest has at least one level")


@dataclass
class Manifest:
    """A dataset's trees: one of each group, and one of their roots."""
    leaves: DataFrame       # all columns given, and tree, leaves, place, digest
    groups: Forest
    top: Forest | None
    root: str | None        # None without any row

    def write(self, path: str) -> None:
        """Write the block tables as Parquet: ``groups/level=k`` and ``top/level=k``."""
        self.groups.write(f"{path.rstrip('/')}/groups")
        if self.top:
            self.top.write(f"{path.rstrip('/')}/top")


def manifest(rows: DataFrame, block_height: int = BLOCK_HEIGHT) -> Manifest:
    """The manifest of ``rows(group, id, digest, ..)``.

    The leaves of a group stand by id, null ids first, equal ids by digest; the
    groups by value, null first, strings bytewise.  The other columns stay with
    their leaves.  Without rows there is no root.
    """
    order = [F.asc_nulls_first("id"), F.asc("digest")]
    # the digests are made once; the sort reads its input several times
    leaves = cut(numbered(cut(rows), [F.col("group")], order, "place", total="leaves", number="tree"))
    groups = build_forest(leaves, block_height)
    subroots = groups.roots().select(F.col("tree").alias("place"), F.col("root").alias("digest"))
    count = subroots.count()
    if not count:
        return Manifest(leaves, groups, None, None)
    top = build_forest(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("leaves"), "place", "digest"),
                       block_height)
    return Manifest(leaves, groups, top, top.roots().first()["root"])


def audit(made: Manifest, claimed: str = "digest", carry: tuple[str, ...] = ()) -> DataFrame:
    """Each leaf with its proof, and the root that a claimed leaf leads to by it.

    ``(*carry, digest, subroot, root, proof_sha256, folded_root)``; ``claimed``
    names the column of ``made.leaves`` that is folded with the leaf's siblings.
    The proof's digest covers the siblings of every level up to the root.
    """
    names = list(carry)
    types = {f.name: f.dataType.simpleString() for f in made.leaves.schema.fields}
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in names], "digest string", "subroot string", "proof_sha256 string", "folded_root string"])
    size = ARITY ** made.groups.block_height
    if made.top is None:
        none = F.lit(None).cast("string")
        return made.leaves.select(*names, "digest", *[none.alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")]).limit(0)
    nothing = F.array().cast("array<string>")
    spark = made.leaves.sparkSession
    crown = block_paths(made.top, spark.range(1).select(F.lit(0).cast("long").alias("tree"), nothing.alias("left"), nothing.alias("right")))
    above = _paths(crown).select(F.col("place").alias("tree"), "left", "right")
    subroots = made.groups.roots().select(F.col("tree").alias("s"), F.col("root").alias("subroot"))
    above = cut(above.join(subroots, F.col("tree") == F.col("s")).drop("s"))
    blocks = block_paths(made.groups, above).select("tree", "block", "height", "count", "nodes", "subroot", "left", "right")
    # names of their own: both sides of the cogroup come from the same rows
    asked = made.leaves.select(F.col("tree").alias("tree"), F.expr(f"place div {size}").alias("block"), F.col("place").alias("place"),
                               F.col("digest").alias("digest"), F.col(claimed).alias("claimed"),
                               *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])

    def fold(leaves: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        b = next(group.itertuples())
        block = Block.load(b.height, b.count, b.nodes)
        upper = list(zip(b.left, b.right))
        tail = "".join(x + y for x, y in upper)
        proofs, roots = [], []
        for place, value in zip(leaves["place"].tolist(), leaves["claimed"].tolist()):
            steps = list(block.siblings(place % size))
            proofs.append(_sha("".join(x + y for x, y in steps) + tail))
            for before, behind in [*steps, *upper]:
                value = _sha(before + value + behind)
            roots.append(value)
        out = {c: leaves[f"c{i}"] for i, c in enumerate(names)}
        return pd.DataFrame(out | {"digest": leaves["digest"], "subroot": b.subroot, "proof_sha256": proofs, "folded_root": roots})

    folded = asked.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(fold, schema)
    return folded.select(*names, "digest", "subroot", F.lit(made.root).alias("root"), "proof_sha256", "folded_root")
