"""Hard negatives against a brute-force version over all rows."""

import math
import random

import numpy as np
import pytest

import __spark_entry__ as E
from tessera.llm import rtree
from tests.oracle import compare, duck_connection

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, is_anchor, scale=256, positives=5, negatives=3, low=50, high=95):
    """Rows of the contract from plain Python integers."""
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(scale * x) for x in vector], label))
    out = []
    for i, (anchor, a, label) in enumerate(kept):
        if not is_anchor(anchor):
            continue
        others = [(-sum(x * y for x, y in zip(a, w)), vec_id, k, other) for k, (vec_id, w, other) in enumerate(kept) if k != i]
        others.sort()
        for p, positive, _, _ in [o for o in others if o[3] == label][:positives]:
            fits = [o for o in others if o[3] != label and low * -p <= 100 * -o[0] <= high * -p][:negatives]
            out += [(anchor, positive, r + 1, n, -p, -s) for r, (s, n, _, _) in enumerate(fits)]
    return sorted(out)


def found(spark, rows, every=5, **how):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, rtree.hard_negatives(frame, frame["vec_id"] % every == 0, **how).collect()))


def clustered(n, width, seed, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    return [(i, [c + rng.gauss(0, 0.7) for c in centres[i % labels]], (i % labels + (rng.random() < 0.2)) % labels) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_over_many_tiles(spark, seed):
    rows = clustered(260, 6, seed)
    want = brute_force(rows, lambda v: v % 5 == 0)
    assert len(want) > 300
    assert found(spark, rows, tile_rows=40, anchor_block=20) == want


def test_ties_copies_and_repeated_ids(spark):
    rng = random.Random(5)
    # a third of all rows are one vector, scores are small integers, some ids occur twice
    rows = [(i, [1.0, 0.5, 0.25], i % 2) for i in range(60)]
    rows += [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(60, 160)]
    rows += rows[10:30]
    want = brute_force(rows, lambda v: v % 5 == 0)
    assert found(spark, rows, tile_rows=16, anchor_block=8) == want


def test_nulls_odd_values_lengths_and_empty_vectors(spark):
    rows = clustered(60, 3, 9) + [
        (None, [1.0, 1.0, 1.0], 0), (100, None, 0), (105, [1.0, None, 1.0], 0), (110, [float("nan"), 1.0, 1.0], 1),
        (115, [float("inf"), 0.0, 0.0], 1), (120, [1.0, 1.0, 1.0], None), (125, [2.0], 0), (130, [], 1), (135, [0.5, 0.5], 2),
        (-5, [1.0, 1.0, 1.0, 9.0], 0), (140, [-3.0, -2.0, -1.0], 1)]
    assert found(spark, rows, tile_rows=25) == brute_force(rows, lambda v: v % 5 == 0)


def test_large_values_stay_exact(spark):
    rows = [(i, [float(2 ** 22 + i), float(-2 ** 21 - 3 * i)], i % 2) for i in range(40)]
    assert found(spark, rows, tile_rows=16) == brute_force(rows, lambda v: v % 5 == 0)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    rows = clustered(50, 3, 4)
    named = [(*r, "x", 1, 2, 3) for r in rows]
    frame = spark.createDataFrame(named, SCHEMA + ", key string, tile int, w int, at int")
    got = rtree.hard_negatives(frame, frame["vec_id"] % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, lambda v: v % 5 == 0)


def test_the_tree_prunes_and_bounds_hold():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 4)) * 300
    points = np.concatenate([c + rng.normal(size=(200, 4)) * 10 for c in centres]).astype(np.int64).astype(np.float64)
    tree = rtree.RTree(points, np.repeat(np.arange(20), 200))
    assert sorted(tree.order.tolist()) == list(range(4000))
    assert len(tree.levels) == 3 and len(tree.levels[-1].low) == 1
    anchor = points[7]
    products = tree.points @ anchor
    up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
    for box in tree.levels[:1]:
        for i, (lo, hi) in enumerate(zip(box.first, box.first[1:])):
            assert box.low[i] @ up + box.high[i] @ down <= products[lo:hi].min()
            assert box.high[i] @ up + box.low[i] @ down >= products[lo:hi].max()
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.points = tree.points.view(Counted)
    ids = np.arange(4000)[tree.order]
    best = tree.search(anchor, -1, 0, True, [(-rtree.NO_LIMIT, rtree.NO_LIMIT)], 5, ids)
    assert [s for s, _ in best[0]] == sorted((points[:200] @ anchor).astype(int).tolist(), reverse=True)[:5]
    assert 0 < sum(seen) < 1000     # of 4,000 rows


def test_matches_oracle(spark):
    sf = "/root/testdata/sf0.01"
    r = compare(E.queries()["op13_negatives"](spark, sf), duck_connection(sf), E.oracle_sql()["op13_negatives"])
    assert r["ok"], r
