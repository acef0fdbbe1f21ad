"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target number of words and a weight schedule over training
time 0..1.  A source's documents, in a fixed pseudo-random order, are laid end
to end, pass after pass, until its target is reached; no document is passed
more than ``CAP`` times.  The integral of the schedule is the cumulative demand
for the source's words, and its inverse at a document's place in that sequence
is the document's training position.  Sorting by position gives the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, packed, row_digest
from tessera.llm.ordering import running_total

# fixed values of the task: weights of the sources in order, repeating, and the cap
WEIGHTS = [5, 2, 1]
CAP = 3

# weight schedules over time 0..1 as (time, weight) knots, linear in between;
# sources take them in turn like the weights
SCHEDULES = [
    [(0.0, 1.5), (1.0, 0.5)],
    [(0.0, 1.0), (1.0, 1.0)],
    [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)],
]

WORD_BREAK = r"[\x20\x09-\x0D]+"


def size_in_words(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1), lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame, weights: list[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, turn, target)`` from rows ``(source, size)``.

    Sources in code point order, null last, take the weights in turn and share
    the total size; a target stops at ``cap`` times its source's size and the
    excess is shared again by weight.  With sources ordered by cap per weight
    the stopped ones come first, so two running totals give the common level at
    which the others settle.  No step gathers all sources in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turns = running_total(cut(totals), [F.asc_nulls_last("source")], {"place": F.lit(1)})
    turns = turns.withColumn("turn", F.pmod("place", F.lit(len(weights))).cast("int"))
    turns = turns.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1).cast("long"))
    turns = turns.withColumn("stop", F.col("source_size") * F.lit(cap)).withColumn("level", F.col("stop") / F.col("weight"))
    run = running_total(cut(turns), [F.col("level"), F.asc_nulls_last("source")], {"stopped": F.col("stop"), "spent": F.col("weight")})
    run = cut(run)
    all_size, all_weight = run.agg(F.sum("source_size"), F.sum("weight")).first()
    # the level at which the sources that are not stopped settle: that of the first one below its own
    shared = (F.lit(all_size).cast("long") - F.col("stopped")) / F.nullif(F.lit(all_weight).cast("long") - F.col("spent"), F.lit(0))
    first = F.struct("level", F.col("source").isNull(), "source", shared.alias("shared"))
    settled = run.agg(F.min(F.when(shared <= F.col("level"), first)).alias("first")).first()["first"]
    water = F.lit(settled["shared"] if settled else 0.0).cast("double")
    target = F.least(F.col("weight") * water, F.col("stop").cast("double"))
    return run.select("source", "source_size", "turn", target.alias("target"))


def position(share: Column, turn: Column, schedules: list[list[tuple[float, float]]] = SCHEDULES) -> Column:
    """Training time at which a share 0..1 of a source's demand is met."""
    def inverse(knots: list[tuple[float, float]]) -> Column:
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        total = sum(areas)
        out, below = F.lit(knots[-1][0]), total
        # from the last segment back: the first one whose demand covers the share wins
        for ((t0, w0), (t1, w1)), area in reversed(list(zip(zip(knots, knots[1:]), areas))):
            below -= area
            x = share * F.lit(total) - F.lit(below)
            slope = (w1 - w0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * x, F.lit(0.0)))
            at = F.lit(t0) + F.when(F.lit(w0) + root > 0, F.lit(2.0) * x / (F.lit(w0) + root)).otherwise(0.0)
            out = F.when(share * F.lit(total) <= F.lit(below + area), at).otherwise(out)
        return out

    out = inverse(schedules[-1])
    for i in range(len(schedules) - 2, -1, -1):
        out = F.when(turn == i, inverse(schedules[i])).otherwise(out)
    return out


def _plan(keyed: DataFrame, weights: list[int], cap: int) -> DataFrame:
    """``keyed(id, source, size, tie)`` with targets and passes, one row each."""
    # the texts are sized once; the sorts read their input several times
    keyed = cut(keyed.withColumn("draw", F.md5(F.col("id").cast("string").cast("binary"))))
    placed = running_total(keyed, [F.asc_nulls_last("source"), F.asc_nulls_last("draw"), F.asc_nulls_last("id"), F.col("tie")],
                           {"before": F.col("size")})
    targets = source_targets(keyed.select("source", "size"), weights, cap)
    starts = running_total(targets, [F.asc_nulls_last("source")], {"start": F.col("source_size")})
    starts = starts.withColumnRenamed("source", "s")
    # a source may hold most rows: its row is on the small side, the other side is split by skew handling
    rows = placed.join(starts, F.col("source").eqNullSafe(F.col("s"))).withColumn("within", F.col("before") - F.col("start"))
    wanted = F.floor("target")

    def one(k: int) -> Column:
        begin = F.col("source_size") * k + F.col("within")
        words = F.greatest(F.lit(0), F.least(F.col("size"), wanted - begin)).cast("long")
        share = (begin + words / 2) / F.greatest(F.col("target"), F.lit(1.0))
        return F.struct(words.alias("words"), position(F.least(share, F.lit(1.0)), F.col("turn")).alias("position"))

    passes = F.filter(F.array(*[one(k) for k in range(cap)]), lambda p: p["words"] > 0)
    return rows.select("id", "source", "tie", "size", "source_size", "target", passes.alias("passes"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: list[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(id_col, size, source_size, target, taken, passes)`` for every row of ``docs``.

    ``passes`` has one ``struct(words, position)`` for each time the mix takes
    the row; all but the last taken of a source are whole.  ``taken`` adds up
    their words, which for every source come to its target rounded down.  Null
    and empty texts have size 0 and no passes.  A null source is a source.
    Repeated rows stay rows of their own; other columns are ignored.  The order
    within a source is that of the id's MD5, so reruns agree.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_in_words(F.col(text_col)).alias("size"),
                        F.xxhash64(text_col).alias("tie"))
    out = _plan(keyed, weights, cap)
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda s, p: s + p["words"])
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), "passes")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: list[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` in training order: a row for each pass, sorted by position.

    Documents the mix does not take go; a document at the end of its source's
    target is kept whole.  Empty texts have no words to take and go.  Rows that
    are equal in all columns are each taken as planned; what tells other rows of
    the same id apart is a digest of the whole row.  Columns stay.
    """
    tie = row_digest(docs)
    keyed = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_in_words(F.col(text_col)).alias("size"), tie.alias("tie"))
    takes = _plan(keyed, weights, cap).select(F.col("tie").alias("take"), F.explode("passes.position").alias("position"))
    # equal rows have as many takes as all of them together, so one of them meets these, where it lies
    unique = packed(docs, id=F.col(id_col), tie=tie).dropDuplicates(["tie"])
    mixed = unique.join(takes, F.col("tie") == F.col("take"))
    return mixed.orderBy("position", "id", "tie").select("doc.*")
