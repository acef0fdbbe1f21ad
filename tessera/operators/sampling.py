"""Seeded, repeatable samples of the vectors (initial k-means centres).

A row's draw order is ``md5("<seed>:<id>")`` (then id, x, y to make the order
total), so a sample depends only on the data and the seed — not on
partitioning or task order — and is uniform over ids.

Scale: the global sample is a TakeOrderedAndProject (each partition keeps its
k best rows); the stratified sample is a row_number <= m filter, which the
optimizer turns into a per-partition group limit before the shuffle, so even
a stratum holding a third of all vectors reaches the final task as at most
m rows per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.fixed import GLOBAL_SAMPLE_BELOW_SPREAD, LANG_SPREAD, LANGS, SAMPLE_SEED
from tessera.functions.text import check_terms


def draw_order(seed: int, id_col: str = "id") -> list[Column]:
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return [key, F.col(id_col), F.col("x"), F.col("y")]


def sample_global(vectors: DataFrame, k: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """k vectors without replacement: ``(cluster, x, y)``, cluster = draw rank - 1."""
    if k <= 0:
        raise ValueError("k must be positive")
    order = draw_order(seed)
    picked = vectors.select("id", "x", "y").orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*draw_order(seed))) - 1
    return picked.select(rank.cast("int").alias("cluster"), "x", "y").orderBy("cluster")


def stratum_picks(vectors: DataFrame, per_stratum: int, seed: int = SAMPLE_SEED,
                  salts: int | None = None) -> DataFrame:
    """The first ``per_stratum`` vectors of every distinct x in draw order:
    ``(x, y, rn)`` with ``rn`` the draw rank within the stratum (1-based).

    The first ``per_stratum`` are taken within (x, salt) sub-groups and then
    among those candidates per x, so a hot stratum is spread over ``salts``
    tasks (default: the session's number of shuffle partitions) and at most
    ``salts * per_stratum`` of its rows meet in one.
    """
    if per_stratum <= 0:
        raise ValueError("per_stratum must be positive")
    if salts is None:
        salts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    if salts <= 0:
        raise ValueError("salts must be positive")
    order = draw_order(seed)
    sub = Window.partitionBy("x", F.pmod(F.xxhash64("id"), F.lit(salts))).orderBy(*order)
    rows = (vectors.select("id", "x", "y").withColumn("_rn", F.row_number().over(sub))
            .where(F.col("_rn") <= per_stratum).drop("_rn"))
    w = Window.partitionBy("x").orderBy(*order)
    return (rows.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= per_stratum)
            .select("x", "y", "rn"))


def sample_stratified(vectors: DataFrame, per_stratum: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """``per_stratum`` vectors from each distinct x: ``(cluster, x, y, rn)``.

    Clusters are numbered by stratum (ascending x), then by draw rank ``rn``.
    A stratum with fewer rows contributes fewer; :func:`initial_means` turns
    that into an error.
    """
    picked = stratum_picks(vectors, per_stratum, seed)
    # global numbering over per_stratum x #strata rows; the strata are the terms
    cluster = F.row_number().over(Window.orderBy("x", "rn")) - 1
    return picked.select(cluster.cast("int").alias("cluster"), "x", "y", "rn")


def sample_vectors(vectors: DataFrame, k: int, terms: Sequence[str] = LANGS,
                   spread: int = LANG_SPREAD, seed: int = SAMPLE_SEED) -> DataFrame:
    """Initial centres as in the original job: a global sample when the
    spread is small, else ``k / #terms`` per stratum (k must divide)."""
    terms = check_terms(terms)
    if spread < GLOBAL_SAMPLE_BELOW_SPREAD:
        return sample_global(vectors, k, seed)
    if k % len(terms) != 0:
        raise ValueError(f"k={k} is not a multiple of the number of terms ({len(terms)})")
    return sample_stratified(vectors, k // len(terms), seed).select("cluster", "x", "y")


def initial_means(vectors: DataFrame, k: int, terms: Sequence[str] = LANGS,
                  spread: int = LANG_SPREAD, seed: int = SAMPLE_SEED) -> list[tuple[int, int]]:
    """Collect the k sampled centres and check the sample's contract: exactly
    k centres, and, when stratified, ``k / #terms`` in every stratum.

    At most k + 1 rows reach the driver (a bounded top-(k+1) in cluster
    order), however many strata the vectors have; centre i is the i-th.
    """
    terms = check_terms(terms)
    if spread < GLOBAL_SAMPLE_BELOW_SPREAD:
        rows = sample_global(vectors, k, seed).collect()
    else:
        if k % len(terms) != 0:
            raise ValueError(f"k={k} is not a multiple of the number of terms ({len(terms)})")
        rows = (stratum_picks(vectors, k // len(terms), seed)
                .orderBy("x", "rn").limit(k + 1).collect())
    if len(rows) > k:
        raise ValueError(f"sample has more than {k} centres (more strata than terms?)")
    if spread >= GLOBAL_SAMPLE_BELOW_SPREAD:
        per = k // len(terms)
        sizes: dict[int, int] = {}
        for r in rows:
            sizes[r["x"]] = sizes.get(r["x"], 0) + 1
        short = {x: n for x, n in sizes.items() if n < per}
        if short:
            raise ValueError(f"strata smaller than {per} rows: {short}")
    if len(rows) != k:
        raise ValueError(f"sample has {len(rows)} centres, expected {k}")
    return [(int(r["x"]), int(r["y"])) for r in rows]
