"""Where a pattern matches in a text, in column expressions only.

All of them take time in proportion to the text and its matches: running totals
over an array are made chunk by chunk, as appending to an array copies it, and
stretches of a long text are cut from chunks of it, as the position of a code
point is found by counting from the start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
RUN = 64                # elements of a chunk of an array
TEXT_RUN = 2048         # code points of a chunk of a text


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chunks(values: Column, size: int = RUN) -> Column:
    """The array in slices of ``size`` elements; none for an empty array."""
    many = F.ceil(F.size(values) / F.lit(size)).cast("int")
    at = F.when(many > 0, F.sequence(F.lit(0), many - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda k: F.slice(values, k * size + 1, F.lit(size)))


def running(values: Column, combine: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """For each element of a long array what ``combine`` makes of all elements before it.

    ``combine`` is associative, ``zero`` its neutral element, the sum's or the
    maximum's for instance.  Chunks of chunks are combined first, so that each
    element costs the same in arrays of any length up to tens of millions.
    """
    start = F.lit(zero).cast("bigint")

    def total(part: Column) -> Column:
        return F.aggregate(part, start, combine)

    def within(part: Column, before: Column) -> Column:
        # appends to an array of at most RUN elements
        first = F.struct(before.alias("now"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, first, lambda acc, x: F.struct(
            combine(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")), lambda acc: acc["out"])

    def spread(parts: Column, before: Column) -> Column:
        return F.flatten(F.zip_with(parts, before, within))

    def level(array: Column, deeper: Callable[[Column], Column]) -> Column:
        # every array is named before a lambda reads it: an expression there is made anew for each element
        return let(array, lambda a: let(chunks(a), lambda parts: let(F.transform(parts, total), lambda sums: spread(parts, deeper(sums)))))

    return level(values, lambda one: level(one, lambda two: level(two, lambda three: within(three, start))))


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct(start, end, value)>`` of the leftmost non-overlapping matches.

    Offsets count code points, the end is exclusive; ``value`` is the match's
    ``group``.  The text between matches and the matches themselves come from
    the same search, so their lengths add up to the offsets.  A text without a
    match costs one search.  The pattern must not match the empty string.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else None
    between = F.split(text, pattern, -1)

    def spans(matches: Column, gaps: Column, inner: Column) -> Column:
        # the piece after the last match has no match beside it
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
        before = running(lengths, lambda x, y: x + y)
        both = F.arrays_zip(before.alias("at"), F.slice(gaps, F.lit(1), F.size(matches)).alias("b"), matches.alias("m"), inner.alias("v"))
        return F.transform(both, lambda x: F.struct(
            (x["at"] + F.length(x["b"])).alias("start"), (x["at"] + F.length(x["b"]) + F.length(x["m"])).alias("end"), x["v"].alias("value")))

    def named(s: Column) -> Column:
        return spans(s["m"], s["b"], s["v"] if group else s["m"])

    parts = [found.alias("m"), between.alias("b")] + ([values.alias("v")] if group else [])
    return F.when(text.rlike(pattern), let(F.struct(*parts), named)).otherwise(F.array().cast(SPAN))


def text_chunks(text: Column, size: int = TEXT_RUN) -> Column:
    """The text in pieces of ``size`` code points."""
    return F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % size), F.lit(0))


def stretch(pieces: Column, start: Column, end: Column, size: int = TEXT_RUN) -> Column:
    """Code points ``start`` to ``end`` of the text that :func:`text_chunks` has cut."""
    first = F.floor(start / size).cast("int")
    last = F.floor((end - 1) / size).cast("int")
    joined = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(joined, (start - first * size + 1).cast("int"), (end - start).cast("int"))).otherwise("")
