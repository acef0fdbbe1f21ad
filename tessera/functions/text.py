"""Column expressions over text: tokens, term mentions, term positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Up to this many terms a list is a literal inside each row (a hash set for
# mentions, a position lookup for tags); beyond it the operators join with the
# term table, as the cost per row would grow with the list.  Both give the same rows.
INLINE_TERMS_MAX = 256


def check_terms(terms: Sequence[str]) -> list[str]:
    """Validate an ordered term list: non-empty strings, no duplicates.

    A duplicated term would be counted twice per article; an empty term would
    match runs of blanks.  Both are rejected rather than reproduced.
    """
    terms = list(terms)
    if not terms:
        raise ValueError("term list is empty")
    for t in terms:
        if not isinstance(t, str) or t == "":
            raise ValueError(f"terms must be non-empty strings, got {t!r}")
    if len(set(terms)) != len(terms):
        dup = sorted({t for t in terms if terms.count(t) > 1})
        raise ValueError(f"duplicate terms: {dup}")
    return terms


def _sql_string(t: str) -> str:
    return "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"


def terms_array(terms: Sequence[str]) -> Column:
    """The ordered term list as a literal ``array<string>``.

    Emitted as one SQL expression, so building it costs one JVM call however
    long the list; terms with quotes or backslashes (whose escaping depends on
    the parser settings) are passed as individual literals instead.
    """
    terms = check_terms(terms)
    if any("'" in t or "\\" in t for t in terms):
        return F.array(*[F.lit(t) for t in terms])
    return F.expr("array(" + ", ".join(_sql_string(t) for t in terms) + ")")


def tokens(text: Column | str) -> Column:
    """Split on the single space character (no regex, no trimming).

    Trailing empty tokens are kept, which is harmless: only non-empty terms
    are ever looked up.
    """
    return F.split(F.col(text) if isinstance(text, str) else text, " ")


def mentions(text: Column | str, term: str) -> Column:
    """True when ``term`` is an exact, case-sensitive token of ``text``."""
    check_terms([term])
    return F.array_contains(tokens(text), F.lit(term))


def mentioned_terms(text: Column | str, terms: Sequence[str]) -> Column:
    """Distinct terms of the list that ``text`` mentions, in text order.

    One pass over the tokens with hash lookups into the (small) term set, so
    the cost is linear in the text and independent of how often a term
    repeats; each term appears at most once per text.
    """
    return F.array_intersect(tokens(text), terms_array(terms))


def term_index(tag: Column | str, terms: Sequence[str]) -> Column:
    """0-based position of the whole tag string in ``terms``.

    NULL tag -> NULL; a tag not in the list -> -1; the first match wins.
    """
    tag = F.col(tag) if isinstance(tag, str) else tag
    return (F.array_position(terms_array(terms), tag) - F.lit(1)).cast("int")
