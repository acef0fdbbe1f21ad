"""Exact per-group order statistics without gathering any group.

``group_medians`` finds, for every group, the middle value(s) of an integer
column under multiplicities by iterative histogram refinement.  A pass counts
the rows of each group's candidate interval per bucket (a grouped aggregation,
combined map-side); a running sum over the buckets of an interval finds the one
that holds the wanted rank, and the interval narrows to that bucket's observed
min..max.  An interval of width W is resolved in about log_buckets(W) passes: a
range of up to 4096 distinct scores in one, a 32-bit range in at most 3.

Everything stays a DataFrame: the intervals (at most two rows per group) are
checkpointed between passes, and the driver only learns whether any is open.
The number of groups has no bound; a pass's window holds one interval's buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

BUCKETS = 4096


def group_medians(df: DataFrame, group: str = "cluster", value: str = "y",
                  weight: str = "n", buckets: int = BUCKETS) -> DataFrame:
    """``(group, median)`` over rows ``(group, value, weight)``.

    Odd count: the middle value; even count: the two middle values' sum
    divided by 2, truncating toward zero.  Rows without a group or value, or
    with no weight, take no part.
    """
    if buckets < 2:
        raise ValueError("need at least 2 buckets")
    base = (df.select(F.col(group).alias("g"), F.col(value).cast("bigint").alias("v"),
                      F.col(weight).cast("bigint").alias("w"))
            .where(F.col("g").isNotNull() & F.col("v").isNotNull() & (F.col("w") > 0)))
    stats = base.groupBy("g").agg(F.sum("w").alias("size"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    # rank: position wanted in the group; want: position within the interval lo..hi
    state = cut_lineage(stats.selectExpr(
        "g", "lo", "hi", "explode(array_distinct(array((size - 1) div 2, size div 2))) AS rank")
        .selectExpr("g", "rank", "lo", "hi", "rank AS want"))
    while not state.where("lo < hi").isEmpty():
        state = cut_lineage(_narrowed(base, state, buckets))
    ends = state.groupBy("g").agg(F.sum("lo").alias("s"), F.count(F.lit(1)).alias("c"))
    return ends.selectExpr(f"g AS `{group}`", "s div c AS median")


def _narrowed(base: DataFrame, state: DataFrame, buckets: int) -> DataFrame:
    """Intervals after one pass; ``lo = hi`` is a found value."""
    ivs = state.where("lo < hi").selectExpr(
        "g AS ig", "rank", "lo", "hi", "want",
        f"greatest(1L, (hi - lo) div {int(buckets)}L + 1L) AS width")
    inside = base.join(ivs, (F.col("g") == F.col("ig")) & F.col("v").between(F.col("lo"), F.col("hi")))
    hist = (inside.groupBy("ig", "rank", "want", F.expr("(v - lo) div width").alias("b"))
            .agg(F.sum("w").alias("cnt"), F.min("v").alias("mn"), F.max("v").alias("mx")))
    upto = Window.partitionBy("ig", "rank").orderBy("b")
    hit = (hist.withColumn("upto", F.sum("cnt").over(upto)).withColumn("below", F.expr("upto - cnt"))
           .where("below <= want AND want < upto"))
    # the bucket's first and last positions are known values
    narrowed = hit.selectExpr(
        "ig AS g", "rank",
        "CASE WHEN want = upto - 1 AND want > below THEN mx ELSE mn END AS lo",
        "CASE WHEN want = below THEN mn ELSE mx END AS hi",
        "want - below AS want")
    return state.where("lo = hi").unionByName(narrowed)
