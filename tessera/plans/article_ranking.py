"""Article dump -> the three term rankings and the inverted index."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.fixed import LANGS
from tessera.functions.text import check_terms
from tessera.operators import ranking
from tessera.sources.articles import parse_article_lines
from tessera.sources.text import read_lines


@dataclass
class Rankings:
    per_term: DataFrame      # every term, zeros kept
    from_index: DataFrame    # articles per term in the inverted index
    combined: DataFrame      # (term, 1) pairs summed map-side


def read_articles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Article dump (one article per line) -> ``(title, text)``."""
    return parse_article_lines(read_lines(spark, path))


def rank_articles(articles: DataFrame, terms: Sequence[str] = LANGS) -> Rankings:
    """The job's three strategies, each computed its own way when it is read.

    One counts every term (zeros kept), one builds the inverted index and
    counts its articles per term, one sums (term, 1) pairs.  Each is one scan of
    the text column with counts combined map-side.
    """
    terms = check_terms(terms)
    index = ranking.inverted_index(articles, terms, keep=("title",))
    return Rankings(
        per_term=ranking.rank_terms(articles, terms),
        from_index=ranking.rank_terms_from_index(index, terms),
        combined=ranking.rank_terms_combined(articles, terms),
    )


def rank_article_file(spark: SparkSession, path: str, terms: Sequence[str] = LANGS) -> Rankings:
    return rank_articles(read_articles(spark, path), terms)


def main(argv: list[str] | None = None) -> None:
    """``python -m tessera.plans.article_ranking DUMP [--terms a,b,…] [--master M]``

    Prints the three rankings (term, article count) of an article dump, and
    how long each took.
    """
    import argparse
    import time

    from tessera.session import build_session

    ap = argparse.ArgumentParser(prog="python -m tessera.plans.article_ranking")
    ap.add_argument("path", help="article dump file or folder (one article per line)")
    ap.add_argument("--terms", help="comma-separated term list (default: the 15 languages)")
    ap.add_argument("--master", default=None, help="Spark master (default local[$BENCH_CPUS or 8])")
    args = ap.parse_args(argv)
    terms = args.terms.split(",") if args.terms else list(LANGS)
    spark = build_session(args.master, app="article-ranking")
    r = rank_article_file(spark, args.path, terms)
    labels = [("per-term counts", r.per_term), ("ranking from the inverted index", r.from_index),
              ("combined count", r.combined)]
    timings = []
    for label, df in labels:
        t0 = time.perf_counter()
        rows = [(x["term"], x["n"]) for x in df.collect()]
        timings.append(f"{label}: {1000 * (time.perf_counter() - t0):.0f} ms")
        print(f"{label}: {rows}")
    print("\n".join(timings))


if __name__ == "__main__":
    main()
