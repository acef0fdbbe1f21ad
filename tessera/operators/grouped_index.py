"""The inverted index in its grouped form: a term's articles as bounded blocks.

The articles of a term are a unit for the reader, but a term that most articles
mention cannot be one row.  A posting list is therefore dealt into blocks of at
most ``per_block`` distinct articles: by a hash of the article into twice as many
buckets as blocks are needed, and a bucket that still holds more is sliced.
Which block an article falls into depends on its own content and on how often
its term is mentioned, not on partitions or task order.

Scale: copies of one article are counted before the articles are dealt, so a
third of all articles being copies of one makes one entry; one group of a task
is one bucket.  What is broadcast has a row for each term of the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed import LANGS
from tessera.functions.text import INLINE_TERMS_MAX, check_terms, mentioned_terms
from tessera.operators.ranking import inverted_index, mention_counts, ranked_counts, term_table

ARTICLES_PER_BLOCK = 500


def _entries(articles: DataFrame, terms: Sequence[str], text: str, keep: Sequence[str]) -> DataFrame:
    """``(term, *keep, copies)``: the distinct articles of every term."""
    terms = check_terms(terms)
    if len(terms) > INLINE_TERMS_MAX:
        return inverted_index(articles, terms, text, keep).groupBy("term", *keep).agg(F.count(F.lit(1)).alias("copies"))
    # each article is counted once, whatever the number of its terms
    found = articles.select(*[F.col(c) for c in keep], mentioned_terms(text, terms).alias("_terms")).where(F.size("_terms") > 0)
    counted = found.groupBy(*keep, "_terms").agg(F.count(F.lit(1)).alias("copies"))
    rows = counted.select(F.explode("_terms").alias("term"), *keep, "copies")
    if text in keep:
        return rows
    # articles that differ only in their text are one entry
    return rows.groupBy("term", *keep).agg(F.sum("copies").alias("copies"))


def grouped_index(articles: DataFrame, terms: Sequence[str] = LANGS, text: str = "text",
                  keep: Sequence[str] = ("title", "text"), per_block: int = ARTICLES_PER_BLOCK) -> DataFrame:
    """Term -> articles, in blocks: ``(term, block, n, articles)``.

    ``articles`` is an array of ``struct(*keep, copies)``, at most ``per_block``
    of them; an article that occurs several times is one entry with its number of
    copies, and ``n`` adds up the copies of the block.  Every mention is in one
    block; blocks of a term are numbered from 0, with gaps where a bucket stayed
    empty.  A term without articles has no block.
    """
    if per_block < 1:
        raise ValueError("per_block must be >= 1")
    keep = list(keep)
    if not keep:
        raise ValueError("an index needs at least one column to keep")
    entries = _entries(articles, terms, text, keep)
    # a term list bounds this side; copies make it an upper bound of the entries
    sizes = mention_counts(articles, terms, text).selectExpr(
        "term AS _term", f"IF(n <= {int(per_block)}, 1L, (2 * n + {int(per_block) - 1}) div {int(per_block)}) AS _buckets")
    order = F.md5(F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in keep]).cast("binary"))
    dealt = entries.withColumn("_order", order).join(F.broadcast(sizes), F.col("term") == F.col("_term"))
    bucket = F.expr("pmod(CAST(conv(substr(_order, 1, 8), 16, 10) AS BIGINT), _buckets)")
    entry = F.struct("_order", F.struct(*keep, "copies").alias("article"))
    lists = dealt.groupBy("term", "_buckets", bucket.alias("_bucket")).agg(F.array_sort(F.collect_list(entry)).alias("_list"))
    slices = lists.select("term", "_buckets", "_bucket", "_list",
                          F.explode(F.expr(f"sequence(0, (size(_list) - 1) div {int(per_block)})")).alias("_slice"))
    blocks = slices.select("term", F.expr("_bucket + _slice * _buckets").alias("block"),
                           F.expr(f"transform(slice(_list, CAST(_slice AS INT) * {int(per_block)} + 1, {int(per_block)}), e -> e.article)").alias("articles"))
    return blocks.selectExpr("term", "block", "aggregate(articles, 0L, (s, a) -> s + a.copies) AS n", "articles")


def merge_grouped_index(index: DataFrame, more: DataFrame) -> DataFrame:
    """``index`` with the blocks of a further dump behind its own, term by term.

    No block is opened: the postings of both stay where they are, an article in
    both dumps counts in both, and the bound on a block holds.  What is broadcast
    has a row for each term.
    """
    last = index.groupBy(F.col("term").alias("_term")).agg(F.max("block").alias("_last"))
    moved = more.join(F.broadcast(last), F.col("term") == F.col("_term"), "left").select(
        "term", (F.col("block") + F.coalesce(F.col("_last") + 1, F.lit(0))).alias("block"), "n", "articles")
    return index.select("term", "block", "n", "articles").unionByName(moved)


def write_grouped_index(index: DataFrame, path: str, dump: str) -> None:
    """Store the blocks of one dump below ``path``, in a folder for each term.

    Each dump has a folder of its own, so adding one rewrites no other, and
    writing a dump again, say after a failure, replaces just that one.
    """
    if not dump or "/" in dump:
        raise ValueError("a dump's name must be a folder name")
    # the values stay in the files: those of folder names are read with guessed types
    rows = index.select("term", "block", "n", "articles", F.lit(dump).alias("dump"), F.col("term").alias("by_term"))
    rows.write.mode("overwrite").partitionBy("by_term").parquet(f"{path.rstrip('/')}/by_dump={dump}")


def read_grouped_index(spark: SparkSession, path: str) -> DataFrame:
    """All dumps: ``(term, block, n, articles, dump)``; a block is known by term, dump and number."""
    return spark.read.parquet(path).select("term", "block", "n", "articles", "dump")


def rank_terms_from_grouped_index(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Articles per term from the blocks' sizes, descending: ``(rank, term, n)``; ties by term position."""
    counts = index.groupBy("term").agg(F.sum("n").alias("n"))
    return ranked_counts(counts, term_table(index, check_terms(terms)), keep_zeros=False)
