"""Whole-column aggregates (map-side combined, one row out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_sum(df: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """Sum of an integer column as BIGINT; 0 for an empty input."""
    return df.agg(F.coalesce(F.sum(F.col(col).cast("bigint")), F.lit(0).cast("bigint")).alias(alias))


def column_max(df: DataFrame, col: str, alias: str = "maximum") -> DataFrame:
    """Largest value of a column; an empty input fails the job."""
    return df.agg(F.count(F.lit(1)).alias("_n"), F.max(col).alias("_m")).select(
        F.when(F.col("_n") > 0, F.col("_m"))
         .otherwise(F.raise_error(F.lit("max of an empty column"))).alias(alias))
