"""Hard negatives found by best-first search in a packed R-tree.

Sort-tile-recursive packing: the rows are sorted by one coordinate and cut into
slabs, the rows of a slab by the next one into tiles, both as distributed sorts;
a task goes on in the same way within its tile, down to leaves.  Every node
keeps the minimum bounding box of its rows.  For an anchor, a box bounds the
inner product of any row in it: each coordinate adds an interval between the
products with its two sides.  A queue gives the box of the highest bound first;
boxes that no score window reaches, or that are strictly below the kth score
found, are dropped with all they hold.  The label is one more side of a box, so
boxes without the wanted labels go as well.

The first search finds an anchor's positives, the second, with the windows their
scores make, its negatives.  A task holds one tile and one block of anchors; the
best rows of every tile are merged by a rank-limited window.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut
from tessera.llm.ranks import numbered
from tessera.llm.topk import integer_weights

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# a negative's score lies between these hundredths of the positive's
LOW, HIGH = 50, 95
TILE_ROWS = 8192
ANCHOR_BLOCK = 1024
LEAF_ROWS = 64
FANOUT = 16
EXACT = 1 << 53         # integers below are exact as doubles
NO_LIMIT = 1 << 62


@dataclass(frozen=True)
class _Level:
    """Boxes of one level; those from ``first[i]`` to ``first[i + 1]`` below are in box i."""
    low: np.ndarray
    high: np.ndarray
    least_label: np.ndarray
    most_label: np.ndarray
    first: np.ndarray


def str_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Positions of the points in sort-tile-recursive order.

    The coordinates of most variance come first.  Each is used once and cuts
    what is left into as many slabs as give every further coordinate the same
    share, in whole leaves.
    """
    n, width = points.shape
    leaves = max(1, math.ceil(n / leaf))
    spread = points.var(axis=0, dtype=np.float64) if n else np.zeros(width)
    axes = np.argsort(-spread, kind="stable")[:max(1, math.ceil(math.log2(max(leaves, 2))))] if width else []

    def tile(at: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        pieces = math.ceil(len(at) / leaf)
        if pieces <= 1 or not axes:
            return [at]
        at = at[np.argsort(points[at, axes[0]], kind="stable")]
        slabs = math.ceil(pieces ** (1 / len(axes)))
        rows = math.ceil(pieces / slabs) * leaf
        return [t for lo in range(0, len(at), rows) for t in tile(at[lo:lo + rows], axes[1:])]

    return np.concatenate(tile(np.arange(n), list(axes)))


class RTree:
    """Packed tree over integer points with labels and ids."""

    def __init__(self, points: np.ndarray, labels: np.ndarray, leaf: int = LEAF_ROWS, fanout: int = FANOUT):
        self.order = str_order(points, leaf)
        self.points, self.labels = points[self.order], labels[self.order]
        self.levels: list[_Level] = []
        low, high, least, most, size = self.points, self.points, self.labels, self.labels, leaf
        while not self.levels or len(low) > 1:
            first = np.append(np.arange(0, len(low), size), len(low))
            at = first[:-1]
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append(_Level(low, high, least, most, first))
            size = fanout

    def search(self, anchor: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[int, int]], k: int,
               ids: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each window ``(least, most)`` of scores the k best rows as ``(score, position)``.

        Rows have the anchor's label (``same``) or another one; the row at
        position ``own`` is the anchor itself.  ``ids``, in the tree's order,
        settle equal scores.
        """
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        found: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        floor = [w[0] for w in windows]         # a score below is of no use to the window

        def wanted(high: float, low: float) -> bool:
            return any(high >= f and low <= w[1] for f, w in zip(floor, windows))

        def push(level: int, lo: int, hi: int) -> None:
            box = self.levels[level]
            highs = box.high[lo:hi] @ up + box.low[lo:hi] @ down
            lows = box.low[lo:hi] @ up + box.high[lo:hi] @ down
            if same:
                fits = (box.least_label[lo:hi] <= label) & (box.most_label[lo:hi] >= label)
            else:
                fits = (box.least_label[lo:hi] != label) | (box.most_label[lo:hi] != label)
            for i in np.flatnonzero(fits).tolist():
                if wanted(highs[i], lows[i]):
                    heapq.heappush(queue, (-highs[i], level, lo + i, lows[i]))

        queue: list[tuple[float, int, int, float]] = []
        push(len(self.levels) - 1, 0, len(self.levels[-1].low))
        while queue:
            high, level, node, low = heapq.heappop(queue)
            if not wanted(-high, low):
                continue
            lo, hi = self.levels[level].first[node:node + 2].tolist()
            if level:
                push(level - 1, lo, hi)
                continue
            scores = self.points[lo:hi] @ anchor
            fits = (self.labels[lo:hi] == label) == same
            if lo <= own < hi:
                fits[own - lo] = False
            for w, (least, most) in enumerate(windows):
                at = np.flatnonzero(fits & (scores >= floor[w]) & (scores <= most))
                if len(at):
                    more = zip((-scores[at]).tolist(), ids[lo + at].tolist(), (lo + at).tolist())
                    found[w] = heapq.nsmallest(k, [*found[w], *more])
                    if len(found[w]) == k:
                        floor[w] = max(least, -found[w][-1][0])
        return [[(int(-s), at) for s, _, at in rows] for rows in found]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of a block, filled up with zeros; doubles where every score is exact as one."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _search_tile(k: int, same: bool):
    """The cogrouped search: anchors ``(key, label, w, of, least, most)`` in a tile ``(key, id, label, w)``.

    The last three are arrays: an anchor's windows, by what they belong to.
    """
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int, int]] = []
        if len(anchors) and len(rows):
            rows = rows.sort_values("key")
            width = max(max(map(len, anchors["w"])), max(map(len, rows["w"])))
            points, queries = _matrix(rows["w"], width), _matrix(anchors["w"], width)
            top = int(np.abs(points).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, width)
            if top < EXACT:
                points, queries = points.astype(np.float64), queries.astype(np.float64)
            tree = RTree(points, rows["label"].to_numpy(np.int64))
            keys, ids = rows["key"].to_numpy()[tree.order], rows["id"].to_numpy()[tree.order]
            at = dict(zip(keys.tolist(), range(len(keys))))
            for vector, a in zip(queries, anchors.itertuples()):
                windows = list(zip(a.least.tolist(), a.most.tolist()))
                best = tree.search(vector, at.get(a.key, -1), a.label, same, windows, k, ids)
                for of, hits in zip(a.of.tolist(), best):
                    out += [(a.key, of, int(keys[p]), int(ids[p]), s) for s, p in hits]
        return pd.DataFrame(out, columns=["anchor", "of", "key", "id", "score"]).astype("int64")

    return run


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _best(anchors: DataFrame, rows: DataFrame, tiles: int, blocks: int, k: int, same: bool) -> DataFrame:
    """``(anchor, of, key, id, score, rank)``: the k best rows of every anchor's windows."""
    # names of their own: both sides come from the same rows
    asked = anchors.select(*[F.col(c).alias(c) for c in ("key", "label", "w", "of", "least", "most")], F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"),
                           _every(tiles).alias("tile"))
    tiled = rows.select("key", "id", "label", "w", "tile", _every(blocks).alias("block"))
    found = (asked.groupBy("block", "tile").cogroup(tiled.groupBy("block", "tile"))
             .applyInPandas(_search_tile(k, same), "anchor long, of long, key long, id long, score long"))
    order = Window.partitionBy("anchor", "of").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _tiled(rows: DataFrame, tile_rows: int) -> DataFrame:
    """``rows`` with a key of their own and the tile: slabs by the first, tiles by the second coordinate."""
    n = rows.count()
    tiles = max(1, math.ceil(n / tile_rows))
    slabs = math.ceil(math.sqrt(tiles))
    slab_rows = math.ceil(tiles / slabs) * tile_rows

    def side(i: int) -> Column:
        return F.coalesce(F.get("w", F.lit(i)), F.lit(0))

    every = [F.asc("id"), F.asc("label"), F.asc("w")]
    first = numbered(rows, [], [side(0).asc(), *every], "key")
    first = cut(first.withColumn("slab", F.floor(F.col("key") / slab_rows)))
    second = numbered(first, [F.col("slab")], [side(1).asc(), F.asc("key")], "at")
    tile = F.col("slab") * math.ceil(slab_rows / tile_rows) + F.floor(F.col("at") / tile_rows)
    return cut(second.select("key", "id", "label", "w", "is_anchor", tile.cast("long").alias("tile")))


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, tile_rows: int = TILE_ROWS, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become floor(scale * x), a score is the integer inner product
    with the anchor, higher ones first, ties by the smaller id.  Anchors are the
    rows where ``is_anchor`` (a condition on the columns of ``vectors``) holds,
    their positives the first ``positives`` other rows of the same label.  For
    each of these the first ``negatives`` rows of another label follow whose
    score is between ``low`` and ``high`` hundredths of the positive's; fewer if
    there are fewer, none for a negative score, which no window follows.

    Rows with a null id, label or vector or a null or non-finite component take
    no part.  Vectors may differ in length: a missing component is zero.  Rows
    that repeat an id stay rows of their own, as anchors and as results; other
    columns are ignored; an empty table gives no rows.  Scores must fit a long.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          integer_weights(F.col(vector_col), scale).alias("w"),
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = _tiled(cut(rows.where("id is not null and label is not null and w is not null")), tile_rows)
    tiles = 1 + rows.agg(F.coalesce(F.max("tile"), F.lit(0))).first()[0]
    anchors = rows.where("is_anchor")
    blocks = max(1, math.ceil(anchors.count() / anchor_block))
    everything = {"of": 0, "least": -NO_LIMIT, "most": NO_LIMIT}
    every = anchors.withColumns({name: F.array(F.lit(v).cast("long")) for name, v in everything.items()})
    near = cut(_best(every, rows, tiles, blocks, positives, True))
    # integer bounds of low * p <= 100 * s <= high * p, for p >= 0
    whole, rest = "score div 100", "score % 100"
    least = F.expr(f"({whole}) * {int(low)} + (({rest}) * {int(low)} + 99) div 100")
    most = F.expr(f"({whole}) * {int(high)} + (({rest}) * {int(high)}) div 100")
    windows = near.where("score >= 0").groupBy(F.col("anchor").alias("k")).agg(F.collect_list(
        F.struct(F.col("key").alias("of"), least.alias("least"), most.alias("most"))).alias("windows"))
    windows = windows.selectExpr("k AS key", "windows.of AS of", "windows.least AS least", "windows.most AS most")
    asked = anchors.join(windows, "key")
    far = _best(asked, rows, tiles, blocks, negatives, False)
    names = anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    known = near.join(names, "anchor").select("anchor", "anchor_id", F.col("key").alias("of"), F.col("id").alias("positive_id"),
                                              F.col("score").alias("positive_score"))
    return far.join(known, ["anchor", "of"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
