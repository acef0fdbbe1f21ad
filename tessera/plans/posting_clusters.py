"""Postings -> best answer scores -> vectors -> seeded k-means -> cluster report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed import (
    KMEANS_ETA, KMEANS_KERNELS, KMEANS_MAX_ITERATIONS, LANG_SPREAD, LANGS, REPORT_HEADER,
    SAMPLE_SEED,
)
from tessera.operators.kmeans import KMeansResult, compact, kmeans_points, weighted_points
from tessera.operators.postings import scored_postings, vector_postings
from tessera.operators.report import cluster_results, report_lines
from tessera.operators.sampling import initial_means
from tessera.session import cut_lineage, local_frame
from tessera.sources.postings import parse_posting_lines
from tessera.sources.text import read_lines


@dataclass
class ClusterJob:
    """What the clustering job found; it holds no cached or written frame."""
    n_vectors: int
    initial: list[tuple[int, int]]
    kmeans: KMeansResult
    rows: list[tuple]           # report rows, at most k
    eta: float = KMEANS_ETA

    @property
    def means(self) -> list[tuple[int, int]]:
        return self.kmeans.means

    def results(self, spark: SparkSession) -> DataFrame:
        """The report as ``(rank, cluster, label, percent, size, median_score)``."""
        return local_frame(
            spark, self.rows,
            "rank INT, cluster INT, label STRING, percent DOUBLE, size BIGINT, median_score INT")

    def trace(self, spark: SparkSession) -> DataFrame:
        """The iteration trace as a DataFrame (k rows per step)."""
        return local_frame(
            spark, self.kmeans.trace,
            "iter INT, cluster INT, old_x INT, old_y INT, new_x INT, new_y INT, shift DOUBLE")

    def means_frame(self, spark: SparkSession) -> DataFrame:
        """The final means as ``(cluster, x, y)`` (k rows)."""
        return local_frame(spark, [(i, x, y) for i, (x, y) in enumerate(self.means)],
                           "cluster INT, x INT, y INT")

    def report(self, spark: SparkSession) -> DataFrame:
        return report_lines(self.results(spark))


def vectors_from_postings(postings: DataFrame, terms: Sequence[str] = LANGS,
                          spread: int = LANG_SPREAD, unknown: str = "keep") -> DataFrame:
    return vector_postings(scored_postings(postings), terms, spread, unknown)


def cluster_postings(postings: DataFrame, terms: Sequence[str] = LANGS,
                     spread: int = LANG_SPREAD, k: int = KMEANS_KERNELS,
                     eta: float = KMEANS_ETA, max_iter: int = KMEANS_MAX_ITERATIONS,
                     seed: int = SAMPLE_SEED, unknown: str = "keep") -> ClusterJob:
    """The whole clustering job over a postings DataFrame.

    The vectors are computed once and checkpointed; the sample is drawn from
    them, and the weighted points derived from them are cached for the k-means
    steps and the report.  The k report rows are finished here and the cache is
    dropped before this returns, also when a step fails.
    """
    vectors = cut_lineage(vectors_from_postings(postings, terms, spread, unknown))
    weighted = cut_lineage(weighted_points(vectors))
    points = compact(weighted, k).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_vectors = points.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        initial = initial_means(vectors, k, terms, spread, seed)
        km = kmeans_points(points, initial, eta, max_iter)
        rows = [tuple(r) for r in cluster_results(points, km.means, terms, spread).collect()]
    finally:
        points.unpersist()
    return ClusterJob(n_vectors, initial, km, rows, eta)


def cluster_posting_file(spark: SparkSession, path: str, **kw) -> ClusterJob:
    """Read a postings CSV (one posting per line) and cluster it."""
    return cluster_postings(parse_posting_lines(read_lines(spark, path)), **kw)


def print_report(job: ClusterJob, spark: SparkSession) -> None:
    """Console form of the report (header + the formatted lines; k rows)."""
    for line in REPORT_HEADER:
        print(line)
    for r in job.report(spark).select("line").collect():
        print(r["line"])


def write_report(job: ClusterJob, spark: SparkSession, path: str, mode: str = "overwrite") -> None:
    """Write the report lines as a single ordered text file."""
    job.report(spark).coalesce(1).sortWithinPartitions("rank").select("line") \
        .write.mode(mode).text(path)


def print_trace(job: ClusterJob, spark: SparkSession) -> None:
    """The trace frame, one line a step and cluster, tab-separated under its column names."""
    trace = job.trace(spark)
    print("\t".join(trace.columns))
    for row in trace.orderBy("iter", "cluster").collect():
        print("\t".join(map(str, row)))
    print(f"stopped after {job.kmeans.iterations} steps, limit for the shift {job.eta}")


def main(argv: list[str] | None = None) -> None:
    """``python -m tessera.plans.posting_clusters CSV [--debug] [--master M]``

    Clusters a postings CSV with the original parameters (15 languages,
    k = 45, spread 50000, eta 20, at most 120 steps) and prints the report.
    """
    import argparse

    from tessera.session import build_session

    ap = argparse.ArgumentParser(prog="python -m tessera.plans.posting_clusters")
    ap.add_argument("path", help="postings CSV file or folder")
    ap.add_argument("--debug", action="store_true", help="print every k-means step")
    ap.add_argument("--master", default=None, help="Spark master (default local[$BENCH_CPUS or 8])")
    args = ap.parse_args(argv)
    spark = build_session(args.master, app="posting-clusters")
    job = cluster_posting_file(spark, args.path)
    if args.debug:
        print_trace(job, spark)
    print_report(job, spark)


if __name__ == "__main__":
    main()
