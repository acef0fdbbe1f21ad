"""Connected components of an undirected graph, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, tasks_for


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component = least node.

    Alternates the large-star and small-star steps of the public two-phase
    algorithm: each replaces a node's links by links to its least neighbour, so
    the graph turns into stars in a logarithmic number of rounds.  Minima are
    combined before the shuffle, and the joins that follow have no other state
    per node, so a hub with very many links is split like any skewed join.
    Every round is checkpointed.  No link of the graph reaches the driver; it
    sees one change flag a round.  Null ends and self links are ignored; an
    empty graph gives no rows.  ``max_rounds`` raises, it never drops links.
    A graph of few links takes few tasks, however many partitions the session's
    shuffles have: a round has a dozen stages, and each task of a stage leaves
    files.
    """
    links = (edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
             .where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    links = cut(links)
    # no step makes more links than there were
    tasks = tasks_for(links.count())
    links = links.coalesce(tasks)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = (both.groupBy("a").agg(F.min("b").alias("m"))
                 .select("a", F.least("a", "m").alias("m")).coalesce(tasks))
        # large star: every larger neighbour moves to the least one
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").coalesce(tasks).distinct().coalesce(tasks))
        # small star: a node's smaller neighbours and itself move to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        moved = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").coalesce(tasks).distinct())
        moved = cut(moved.coalesce(tasks))
        # stars only: every leaf has one centre, and no node is both a leaf and a centre
        ends = moved.select(F.col("a").alias("node"), F.lit(1).alias("leaf")).unionByName(
            moved.select(F.col("b").alias("node"), F.lit(0).alias("leaf")))
        again = not ends.groupBy("node").agg(F.sum("leaf").alias("centres"), F.min("leaf").alias("least")).coalesce(tasks).where(
            "centres > 1 or centres = 1 and least = 0").isEmpty()
        links = moved
        if not again:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    leaves = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").coalesce(tasks)
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct().coalesce(tasks)
    return leaves.unionByName(centres)
