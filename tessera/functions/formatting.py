"""Report text as a column, so any sink can write it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed import REPORT_LINE_FORMAT


def report_line(median_score: Column | str = "median_score", label: Column | str = "label",
                percent: Column | str = "percent", size: Column | str = "size") -> Column:
    """One fixed-width report line: score, dominant label, percent (1 decimal,
    half-up), cluster size — the format of the original console report."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.format_string(REPORT_LINE_FORMAT, col(median_score), col(label),
                           col(percent), col(size))
