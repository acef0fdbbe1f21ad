"""Place of every row within its key, without gathering a key in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut

ROWS_PER_RANGE = 250_000


def numbered(df: DataFrame, key: list[Column], order: list[Column], name: str = "place",
             rows_per_range: int = ROWS_PER_RANGE, total: str | None = None, number: str | None = None) -> DataFrame:
    """``df`` with ``name``: how many rows of the same key stand before a row, a long from 0.

    ``total`` also names the number of rows of its key, ``number`` the key's
    place among the distinct keys; both or neither are given.  ``key`` and ``order`` are sort expressions; nulls of a key are one key.  The
    rows are range-partitioned by both and checkpointed, with one range for each
    ``rows_per_range`` rows, so a range does not grow with the table; a key that
    holds most rows covers many ranges.  What is ordered beyond a range is one
    row for each key and range.  Rows that tie in the whole order take any order
    among themselves: read the result through a checkpoint where that matters.
    """
    rows = df.withColumns({f"_key{i}": k for i, k in enumerate(key)})
    keys = [f"_key{i}" for i in range(len(key))]
    n = max(1, math.ceil(df.count() / rows_per_range))
    by = [F.asc_nulls_first(k) for k in keys] + order
    placed = cut(rows.repartitionByRange(n, *by).withColumn("_range", F.spark_partition_id()))
    counts = placed.groupBy("_range", *keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    extra = []
    if total and number:
        # one row for each key, joined to one row for each key and range
        names = cut(counts.groupBy(*keys).agg(F.sum("_n").alias("_total")))
        names = numbered(names, [], [F.asc_nulls_first(k) for k in keys], "_number", rows_per_range)
        names = names.select(*[F.col(k).alias(f"_t{k}") for k in keys], F.col("_total").alias(total), F.col("_number").alias(number))
        equal = F.lit(True)
        for k in keys:
            equal = equal & F.col(k).eqNullSafe(F.col(f"_t{k}"))
        starts, extra = starts.join(names, equal), [total, number]
    starts = starts.select(*extra, F.col("_range").alias("_r"), *[F.col(k).alias(f"_s{k}") for k in keys], "_start")
    # the range is part of the join key, so no key is hotter than a range
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_s{k}"))
    local = Window.partitionBy("_range", *keys).orderBy(*order)
    joined = placed.join(starts, same).withColumn(name, F.row_number().over(local) - 1 + F.col("_start"))
    return joined.drop("_range", "_r", "_start", *keys, *[f"_s{k}" for k in keys])
