"""Article term ranking: mention counts, the inverted index, and rankings.

An article *mentions* a term when the term is one of its space-separated
tokens (exact, case-sensitive); an article counts once per term however often
it repeats the term.  All rankings sort by count descending, ties broken by
the term's position in the term list, and expose the order as ``rank``.

Scale: every operator here is one scan of the articles.  Only the text column
is read; it is reduced to at most one row per (article, mentioned term)
before any exchange, and the counting aggregations combine map-side, so what
crosses the network is at most (#terms x #partitions) partial counts — a
term that occurs in every article costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.fixed import LANGS
from tessera.functions.text import (
    INLINE_TERMS_MAX, check_terms, mentioned_terms, mentions, terms_array, tokens,
)


def term_table(articles: DataFrame, terms: Sequence[str]) -> DataFrame:
    """The ordered term list as rows ``(pos INT, term STRING)``.

    Built inside the plan from a literal array (no driver-side data), with as
    many rows as the parameter list.
    """
    return (articles.sparkSession.range(1)
            .select(F.posexplode(terms_array(terms)).alias("pos", "term"))
            .selectExpr("CAST(pos AS INT) AS pos", "term"))


def term_occurrences(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """Number of articles mentioning one term: a single row ``(term, n)``."""
    return articles.agg(F.count_if(mentions(text, term)).alias("n")).select(
        F.lit(term).alias("term"), F.col("n").cast("bigint").alias("n"))


def occurrences_of_term(articles: DataFrame, term: str, text: str = "text") -> int:
    """:func:`term_occurrences` as a Python int (one aggregate action)."""
    return int(term_occurrences(articles, term, text).first()["n"])


def _mention_rows(articles: DataFrame, terms: Sequence[str], text: str) -> DataFrame:
    """One ``term`` row per (article, mentioned term)."""
    terms = check_terms(terms)
    if len(terms) <= INLINE_TERMS_MAX:
        return articles.select(F.explode(mentioned_terms(text, terms)).alias("term"))
    words = articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"))
    return words.join(term_table(articles, terms).select("term"), "term", "left_semi")


def mention_counts(articles: DataFrame, terms: Sequence[str] = LANGS,
                   text: str = "text") -> DataFrame:
    """``(term, n)`` for every term mentioned at least once (map-side combined)."""
    return (_mention_rows(articles, terms, text)
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def ranked_counts(counts: DataFrame, terms: DataFrame, keep_zeros: bool) -> DataFrame:
    """Rank ``(term, n)`` counts against the term table: ``(rank, term, n)``,
    n descending, ties by term position; ``keep_zeros`` adds unmentioned terms."""
    how = "left" if keep_zeros else "inner"
    joined = terms.join(counts, "term", how).select(
        "pos", "term", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
    # a global window, but over at most len(terms) rows
    order = Window.orderBy(F.col("n").desc(), F.col("pos").asc())
    return (joined.select(F.row_number().over(order).cast("int").alias("rank"), "term", "n")
            .orderBy("rank"))


def rank_terms(articles: DataFrame, terms: Sequence[str] = LANGS,
               text: str = "text") -> DataFrame:
    """Every term with its article count, zeros kept: ``(rank, term, n)``.

    Same answer as counting each term with its own scan, from one scan.
    """
    terms = check_terms(terms)
    return ranked_counts(mention_counts(articles, terms, text), term_table(articles, terms),
                         keep_zeros=True)


def rank_terms_combined(articles: DataFrame, terms: Sequence[str] = LANGS,
                        text: str = "text") -> DataFrame:
    """Emit (term, 1) per mention and sum with map-side combine: ``(rank, term, n)``.

    Terms that no article mentions do not appear.
    """
    terms = check_terms(terms)
    return ranked_counts(mention_counts(articles, terms, text), term_table(articles, terms),
                         keep_zeros=False)


def inverted_index(articles: DataFrame, terms: Sequence[str] = LANGS,
                   text: str = "text", keep: Sequence[str] = ("title", "text")) -> DataFrame:
    """Flat inverted index: one row ``(term, *keep)`` per article mentioning a term.

    The index is kept flat: collecting every article of a term into one row
    would put a term found in most articles into a single task.  To store it
    grouped, write it partitioned by term (:func:`write_inverted_index`); each
    task then writes its own slice of every term.
    """
    terms = check_terms(terms)
    if len(terms) <= INLINE_TERMS_MAX:
        return articles.select(F.explode(mentioned_terms(text, terms)).alias("term"), *[F.col(c) for c in keep])
    words = articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"), *[F.col(c) for c in keep])
    return words.join(term_table(articles, terms).select("term"), "term", "left_semi")


def write_inverted_index(index: DataFrame, path: str, mode: str = "overwrite",
                         files_per_term: int | None = 16, salt_column: str = "title") -> None:
    """Persist the flat index as a term-partitioned Parquet table.

    The rows are shuffled by (term, a hash of ``salt_column`` modulo
    ``files_per_term``): each term gets at most that many files however many
    tasks read the articles, and a term found in most articles is spread over
    that many writer tasks instead of landing in one.  ``None`` skips the
    shuffle: every task then writes its own file for each term it holds.
    """
    if files_per_term is not None:
        if files_per_term < 1:
            raise ValueError("files_per_term must be >= 1")
        salt = F.pmod(F.xxhash64(salt_column), F.lit(files_per_term))
        index = index.repartition(F.col("term"), salt)
    index.write.mode(mode).partitionBy("term").parquet(path)


def rank_terms_from_index(index: DataFrame, terms: Sequence[str] | None = None) -> DataFrame:
    """Articles per term from the flat index: ``(rank, term, n)``.

    Ties go by term position when ``terms`` is given, else by term.  An index has
    at most as many terms as the list it was built with, so the window that
    numbers them is as small as that list.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    if terms is not None:
        return ranked_counts(counts, term_table(index, terms), keep_zeros=False)
    order = Window.orderBy(F.col("n").desc(), F.col("term").asc())
    return (counts.select(F.row_number().over(order).cast("int").alias("rank"), "term",
                          F.col("n").cast("bigint").alias("n"))
            .orderBy("rank"))


def index_term_count(index: DataFrame) -> int:
    """Number of distinct terms in the index (its number of keys)."""
    return int(index.select("term").distinct().count())
