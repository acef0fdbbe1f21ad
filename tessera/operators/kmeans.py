"""Integer k-means (Lloyd iteration) over 2-D integer vectors.

Rules: squared euclidean distance; nearest centre with ties to the lowest
index and the distance cap (see ``tessera.functions.geometry``); new mean =
per-axis BIGINT sum div count (truncating toward zero); a cluster that gets
no point keeps its mean; stop when the total squared shift < eta or after
``max_iter`` updates, returning the last update either way.

Execution: vectors are first compressed to distinct ``(x, y, n)`` points —
exact, since sums become sum(x*n) and counts sum(n) — and that small table is
checkpointed, dealt into tasks by the distances a step computes, and cached.
Each step is then one Spark job: assign every point with a literal centre
array, aggregate per cluster with map-side partial sums, and bring back k rows.  The driver holds only the k current means; lineage does not
grow with the number of steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed import KMEANS_ETA, KMEANS_MAX_ITERATIONS
from tessera.functions.geometry import nearest_centre, squared_distance
from tessera.session import cut_lineage

Centres = Sequence[tuple[int, int]]


def weighted_points(vectors: DataFrame, weight: str | None = None) -> DataFrame:
    """Distinct ``(x, y)`` with multiplicity ``n`` (BIGINT)."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return vectors.groupBy("x", "y").agg(n.cast("bigint").alias("n"))


def assign_clusters(points: DataFrame, centres: Centres, method: str = "auto") -> DataFrame:
    """Adds ``cluster``: the nearest centre of each row's (x, y)."""
    return points.withColumn("cluster", nearest_centre("x", "y", centres, method))


def average_vectors(vectors: DataFrame, weight: str | None = None) -> DataFrame:
    """Component-wise integer mean of a set of vectors: one row ``(x, y)``.

    BIGINT sums div the count, truncating toward zero (an empty input gives
    NULLs).  One global aggregate with map-side partial sums.
    """
    w = f"CAST(`{weight}` AS BIGINT)" if weight else "1L"
    return vectors.agg(F.expr(f"sum(CAST(x AS BIGINT) * {w}) AS sx"),
                       F.expr(f"sum(CAST(y AS BIGINT) * {w}) AS sy"),
                       F.expr(f"sum({w}) AS cnt")).select(
        F.expr("sx div cnt").cast("int").alias("x"), F.expr("sy div cnt").cast("int").alias("y"))


def cluster_sums(points: DataFrame, centres: Centres, weight: str | None = "n",
                 method: str = "auto") -> DataFrame:
    """``(cluster, sx, sy, size)``: BIGINT coordinate sums and point count of
    every non-empty cluster (partial sums combine map-side)."""
    # aggregates as SQL text: one JVM call each (this runs once per k-means step)
    w = f"CAST(`{weight}` AS BIGINT)" if weight else "1L"
    return (points.groupBy(nearest_centre("x", "y", centres, method).alias("cluster"))
            .agg(F.expr(f"sum(CAST(x AS BIGINT) * {w}) AS sx"),
                 F.expr(f"sum(CAST(y AS BIGINT) * {w}) AS sy"),
                 F.expr(f"CAST(sum({w}) AS BIGINT) AS size")))


def update_means(points: DataFrame, centres: Centres, weight: str | None = "n",
                 method: str = "auto") -> DataFrame:
    """One Lloyd step as a DataFrame: ``(cluster, x, y, size)`` of the new mean
    of every non-empty cluster (BIGINT sums div counts, truncating)."""
    return cluster_sums(points, centres, weight, method).select(
        "cluster", F.expr("sx div size").cast("int").alias("x"),
        F.expr("sy div size").cast("int").alias("y"), "size")


def _tdiv(a: int, b: int) -> int:
    """Integer division truncating toward zero (as Spark's ``div``)."""
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def point_distance(a: tuple[int, int], b: tuple[int, int]) -> float:
    """Squared distance of two points (driver-side, on the k means)."""
    dx, dy = float(a[0] - b[0]), float(a[1] - b[1])
    return dx * dx + dy * dy


def total_shift(old: Centres, new: Centres) -> float:
    """Sum of squared distances between two equally long centre lists."""
    if len(old) != len(new):
        raise ValueError("centre lists differ in length")
    acc = 0.0
    for a, b in zip(old, new):
        acc += point_distance(a, b)
    return acc


def total_shift_frame(old: DataFrame, new: DataFrame) -> DataFrame:
    """Total shift of two ``(cluster, x, y)`` frames: one row ``total_shift``.

    Both must have the same clusters; one that is missing on a side fails the
    job.  Two empty frames have shift 0.
    """
    o = old.select("cluster", F.col("x").alias("ox"), F.col("y").alias("oy"))
    n = new.select("cluster", F.col("x").alias("nx"), F.col("y").alias("ny"))
    both = F.col("ox").isNotNull() & F.col("nx").isNotNull()
    missing = F.raise_error(F.concat(F.lit("cluster on one side only: "), F.col("cluster").cast("string")))
    shift = F.when(both, squared_distance("ox", "oy", "nx", "ny")).otherwise(missing.cast("double"))
    return o.join(n, "cluster", "full_outer").agg(F.coalesce(F.sum(shift), F.lit(0.0)).alias("total_shift"))


def converged(distance: float, eta: float = KMEANS_ETA) -> bool:
    return distance < eta


@dataclass
class KMeansResult:
    means: list[tuple[int, int]]
    iterations: int
    converged: bool
    shifts: list[float] = field(default_factory=list)
    # (iter, cluster, old_x, old_y, new_x, new_y, shift) per step and cluster
    trace: list[tuple[int, int, int, int, int, int, float]] = field(default_factory=list)


def kmeans_step(points: DataFrame, means: Centres, method: str = "auto") -> list[tuple[int, int]]:
    """New means after one step; clusters without points keep their mean."""
    new = [tuple(m) for m in means]
    for r in cluster_sums(points, means, "n", method).collect():
        new[r["cluster"]] = (_tdiv(r["sx"], r["size"]), _tdiv(r["sy"], r["size"]))
    return new


# Distances (rows x centres) that one task of a step should compute: a step of a
# few small tasks on small inputs, and all cores once the work is worth it.
DISTANCES_PER_TASK = 500_000


def step_tasks(n: int, k: int) -> int:
    """Tasks of a k-means step over ``n`` points and ``k`` centres."""
    return max(1, -(-n * k // DISTANCES_PER_TASK))


def compact(points: DataFrame, k: int, n: int | None = None) -> DataFrame:
    """``points`` in as many partitions as its k-means steps should have tasks
    (``n``: its row count, if already known)."""
    return points.repartition(step_tasks(points.count() if n is None else n, k))


def kmeans_points(points: DataFrame, initial: Centres, eta: float = KMEANS_ETA,
                  max_iter: int = KMEANS_MAX_ITERATIONS,
                  method: str = "auto") -> KMeansResult:
    """Run k-means over weighted points ``(x, y, n)`` (cached, with a short
    lineage, see :func:`compact`) from ``initial`` until the shift < eta or
    ``max_iter`` steps."""
    if max_iter < 1:
        raise ValueError("max_iter must be >= 1")
    means = [(int(x), int(y)) for x, y in initial]
    res = KMeansResult(means=means, iterations=0, converged=False)
    for it in range(1, max_iter + 1):
        new = kmeans_step(points, means, method)
        shift = total_shift(means, new)
        res.trace.extend((it, c, o[0], o[1], n[0], n[1], point_distance(o, n))
                         for c, (o, n) in enumerate(zip(means, new)))
        res.shifts.append(shift)
        res.iterations, res.means = it, new
        means = new
        if converged(shift, eta):
            res.converged = True
            break
    return res


def kmeans(vectors: DataFrame, initial: Centres, eta: float = KMEANS_ETA,
           max_iter: int = KMEANS_MAX_ITERATIONS, weight: str | None = None,
           method: str = "auto") -> KMeansResult:
    """k-means over raw vectors ``(x, y[, weight])``: compresses them to
    weighted points, cuts their lineage, iterates, and releases them."""
    points = cut_lineage(weighted_points(vectors, weight))
    spread = compact(points, len(initial)).persist()
    try:
        return kmeans_points(spread, initial, eta, max_iter, method)
    finally:
        spread.unpersist()
