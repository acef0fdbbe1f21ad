"""Article line parser: ``<14 chars>title</title><text>text<16 chars>``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed import ARTICLE_MARKER, ARTICLE_PREFIX_LEN, ARTICLE_SUFFIX_LEN


def parse_article_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``value`` lines -> ``(title, text)``.

    The title runs from character 14 to the first marker, the text from just
    after the marker to 16 characters before the end; the fixed prefix and
    suffix are dropped unread.  A line without the marker, with the marker
    inside the prefix, or too short for the suffix fails the job, also when rows
    are only counted.
    Offsets count characters (code points).
    """
    v = F.col(value)
    m = len(ARTICLE_MARKER)
    i = F.instr(v, ARTICLE_MARKER) - F.lit(1)          # 0-based, -1 when absent
    n = F.length(v)
    text_start = i + F.lit(m)
    text_len = n - F.lit(ARTICLE_SUFFIX_LEN) - text_start
    ok = (i >= F.lit(ARTICLE_PREFIX_LEN)) & (text_len >= F.lit(0))
    # a row condition: it also holds where no column of the result is read
    checked = F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("malformed article line: "), F.substring(v, 1, 120))).cast("boolean"))
    return lines.where(checked).select(
        v.substr(F.lit(ARTICLE_PREFIX_LEN + 1), i - F.lit(ARTICLE_PREFIX_LEN)).alias("title"),
        v.substr(text_start + F.lit(1), text_len).alias("text"),
    )
