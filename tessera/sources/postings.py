"""Posting CSV parser: ``type,id,accepted,parent,score[,tags[,…]]``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

POSTING_SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("accepted_answer", T.LongType(), True),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("tags", T.StringType(), True),
])
POSTING_COLUMNS = [f.name for f in POSTING_SCHEMA.fields]

def _is_int(i: int, to: str) -> str:
    """SQL: field i is a decimal integer that fits — no blanks, no fraction, no
    overflow — whatever the session's ANSI setting."""
    return f"(translate(f[{i}], '+-0123456789', '') = '' AND try_cast(f[{i}] AS {to}) IS NOT NULL)"


def _check(i: int, to: str, what: str, optional: bool = False) -> str:
    empty = f"f[{i}] = '' OR " if optional else ""
    return f"WHEN NOT ({empty}{_is_int(i, to)}) THEN raise_error(concat('bad {what} field: <', f[{i}], '>'))"


# The check of a whole line is a row condition: it stays in every plan, however
# few of the parsed columns are used.  Nearly all lines pass by their form alone
# (numbers too short to overflow); the others are looked at field by field.
_PLAIN = ("^[+-]?[0-9]{1,9},[+-]?[0-9]{1,18},([+-]?[0-9]{1,18})?,([+-]?[0-9]{1,18})?,"
          "[+-]?[0-9]{1,9}(?![^,])")
_FIELDS_CHECK = f"""CASE
  WHEN coalesce(size(f) < 5, true) THEN raise_error('posting line has fewer than 5 fields')
  {_check(0, 'INT', 'posting type')}
  {_check(1, 'BIGINT', 'id')}
  {_check(2, 'BIGINT', 'accepted answer', optional=True)}
  {_check(3, 'BIGINT', 'parent id', optional=True)}
  {_check(4, 'INT', 'score')}
  ELSE true END"""


def parse_posting_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``value`` lines -> postings (``POSTING_SCHEMA``).

    Split on ``,`` with trailing empty fields dropped, no quoting.  Fields 0-4
    must exist; ``''`` in fields 2 and 3 means NULL; field 5 is the tag
    string when present (possibly ``''``), NULL otherwise; further fields are
    ignored.  Any malformed number fails the job, whichever columns are read
    from the result and also when its rows are only counted.  Ids are read as
    BIGINT (2^31 ids run out long before 100 TB); type and score stay INT.
    """
    # trailing separators go first (character trim, no regex), then split
    split = f"split(trim(TRAILING ',' FROM `{value}`), ',', -1)"
    checked = lines.where(f"coalesce(`{value}` RLIKE '{_PLAIN}', false) OR exists(array({split}), f -> {_FIELDS_CHECK})")
    fields = checked.selectExpr(f"{split} AS f")
    return fields.selectExpr(
        "try_cast(f[0] AS INT) AS posting_type",
        "try_cast(f[1] AS BIGINT) AS id",
        # a failing try_cast is slow, so empty fields do not reach it
        "try_cast(nullif(f[2], '') AS BIGINT) AS accepted_answer",
        "try_cast(nullif(f[3], '') AS BIGINT) AS parent_id",
        "try_cast(f[4] AS INT) AS score",
        "get(f, 5) AS tags",
    )
