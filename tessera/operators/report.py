"""Per-cluster report: dominant term, its share, cluster size, median score.

Runs on the weighted points (x, y, n) — exact for every statistic here.  The
points are assigned once and added up by (cluster, term index, score); that
frame, checkpointed, gives the dominant term (map-side combined sums) and the
median, by an exact distributed selection (``tessera.operators.selection``)
that refines per-cluster score histograms, so no cluster — however large — is
gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.fixed import LANG_SPREAD, LANGS
from tessera.functions.formatting import report_line
from tessera.functions.text import terms_array
from tessera.operators.kmeans import Centres, assign_clusters
from tessera.operators.selection import group_medians
from tessera.session import cut_lineage


def cluster_results(points: DataFrame, means: Centres, terms: Sequence[str] = LANGS,
                    spread: int = LANG_SPREAD, weight: str | None = "n",
                    method: str = "auto") -> DataFrame:
    """``(rank, cluster, label, percent, size, median_score)`` per non-empty cluster.

    label = the term whose index (x div spread) is most frequent in the
    cluster (ties to the lower index; an index outside the term list fails
    the job); percent = its share x 100; median_score = middle score, or the
    two middle scores' sum div 2 (truncating).  Sorted by median score, then
    cluster, with ``rank`` recording that order.

    The medians are found when this is called (a few small Spark jobs, see
    ``tessera.operators.selection``); everything else is evaluated lazily.
    """
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    assigned = assign_clusters(points.select("x", "y", w.alias("n")), means, method)
    assigned = cut_lineage(
        assigned.groupBy("cluster", F.expr(f"x div {int(spread)}").cast("int").alias("lang"), "y")
        .agg(F.sum("n").alias("n")))

    by_term = assigned.groupBy("cluster", "lang").agg(F.sum("n").alias("cnt"))
    top = (by_term.groupBy("cluster")
           .agg(F.max(F.struct(F.col("cnt"), (-F.col("lang")).alias("neg"), F.col("lang"))).alias("top"),
                F.sum("cnt").alias("size")))
    medians = group_medians(assigned, "cluster", "y", "n").withColumnRenamed("median", "med")

    n_terms = len(terms)
    lang = F.col("top.lang")
    label = F.when((lang >= 0) & (lang < n_terms), F.element_at(terms_array(terms), lang + 1)) \
             .otherwise(F.raise_error(F.concat(F.lit("dominant term index outside the term list: "),
                                               lang.cast("string"))))
    summary = top.join(medians, "cluster").select(
        "cluster",
        label.alias("label"),
        ((F.col("top.cnt") / F.col("size")) * F.lit(100)).cast("double").alias("percent"),
        F.col("size").cast("bigint").alias("size"),
        F.col("med").cast("int").alias("median_score"),
    )
    order = Window.orderBy("median_score", "cluster")   # over at most k rows
    return (summary.select(F.row_number().over(order).cast("int").alias("rank"), "*")
            .orderBy("rank"))


def report_lines(results: DataFrame) -> DataFrame:
    """``(rank, line)``: the report body, one formatted line per cluster."""
    return results.select("rank", report_line().alias("line")).orderBy("rank")
