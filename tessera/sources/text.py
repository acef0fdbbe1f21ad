"""Text line source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in a ``value STRING`` column.

    Uncompressed (or splittable-codec, e.g. bzip2) files are split into
    ``spark.sql.files.maxPartitionBytes`` chunks, so a single huge file still
    reads in parallel; a gzip file is read whole by one task, so large dumps
    should be stored uncompressed, bzip2-compressed, or as many gzip files.
    A missing path fails at plan time.
    """
    return spark.read.text(path)
