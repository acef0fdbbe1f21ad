"""Running totals over a global order without gathering the rows in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut

ROWS_PER_RANGE = 250_000


def running_total(df: DataFrame, order: list[Column], values: dict[str, Column], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``df`` with, for each name, the sum of the values of all rows before it.

    Rows are range-partitioned by ``order``, one range for each ``rows_per_range``
    of them, and checkpointed, which fixes the ranges; each range sums its own rows and adds the total of the ranges before
    it.  One row per range is ordered in a single task; no other step sees more
    than a range.  ``df`` is read several times; hand in a table or a checkpoint.  Sums of integers are exact and rows that tie in the whole
    order are interchangeable.
    """
    n = max(1, math.ceil(df.count() / rows_per_range))
    placed = cut(df.withColumns({f"_v_{k}": v for k, v in values.items()})
                 .repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy("_range").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values])
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in values])
    local = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row for each of n ranges
    joined = placed.join(offsets.hint("broadcast"), "_range")
    return joined.withColumns({k: F.coalesce(F.sum(f"_v_{k}").over(local), F.lit(0)) + F.col(f"_o_{k}") for k in values}).drop(
        "_range", *[f"_{x}_{k}" for x in "vo" for k in values])
