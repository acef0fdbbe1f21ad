"""Adapters from the driver's Parquet tables to the operators' input schemas.

The original programs read an article dump and a postings CSV that are not
available; these functions only reshape the given tables into rows of the
expected schema.  They do none of the operators' work, and no operator relies
on how these rows were made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed import ARTICLE_MARKER, ARTICLE_PREFIX_LEN, ARTICLE_SUFFIX_LEN
from tessera.sources.postings import POSTING_COLUMNS

# Terms ranked over `documents`: frequent tokens of the four languages in the
# prose, plus one term that never occurs (exercises the zero-count rule).
DOCUMENT_TERMS = ("the", "and", "The", "de", "le", "der", "und", "el", "zzz-absent")

# Tags of the postings adapter are the order priorities.  An order whose
# priority is not specified becomes a question without a tag (which the
# vectors count as the first term); the other four priorities are the terms.
UNSPECIFIED_PRIORITY = "4-NOT SPECIFIED"
PRIORITY_TERMS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")

# Clustering parameters for the postings adapter: 3 centres per priority.
ADAPTER_K = 12
ADAPTER_SPREAD = 50000

# Filler around an article line: exactly as long as the parser skips.
ARTICLE_PREFIX = "<page> <title>"
ARTICLE_SUFFIX = "</text>  </page>"
assert len(ARTICLE_PREFIX) == ARTICLE_PREFIX_LEN and len(ARTICLE_SUFFIX) == ARTICLE_SUFFIX_LEN


# Reader schemas of the columns the adapters use: declared rather than
# inferred, so planning reads no file footers; Parquet maps columns by name.
ADAPTER_COLUMNS = {
    "documents": "doc_id BIGINT, text STRING",
    "orders": "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE",
}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with all its columns (schema inferred from the files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapter_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with just the columns the adapters use (declared schema)."""
    return spark.read.schema(ADAPTER_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- articles --

def articles_from_documents(documents: DataFrame) -> DataFrame:
    """``documents`` -> ``(title, text)`` with the doc id as title."""
    return documents.selectExpr("CAST(doc_id AS STRING) AS title", "text")


def article_lines(articles: DataFrame) -> DataFrame:
    """``(title, text)`` -> ``value`` lines in the dump's layout."""
    return articles.select(F.concat(F.lit(ARTICLE_PREFIX), F.col("title"), F.lit(ARTICLE_MARKER),
                                    F.col("text"), F.lit(ARTICLE_SUFFIX)).alias("value"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(adapter_table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- postings --

def postings_from_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders become questions, line items their answers.

    question: type 1, id = order key, accepted answer = its first line's id,
              score = total price div 1000, tags = order priority (none when
              the priority is not specified)
    answer:   type 2, id = 8 * order key + line number, parent = order key,
              score = extended price div 100, no tags
    """
    questions = orders.selectExpr(
        "1 AS posting_type",
        "CAST(o_orderkey AS BIGINT) AS id",
        "CAST(o_orderkey * 8 + 1 AS BIGINT) AS accepted_answer",
        "CAST(NULL AS BIGINT) AS parent_id",
        "CAST(floor(o_totalprice / 1000) AS INT) AS score",
        f"CASE WHEN o_orderpriority <> '{UNSPECIFIED_PRIORITY}' THEN o_orderpriority END AS tags",
    )
    answers = lineitem.selectExpr(
        "2 AS posting_type",
        "CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id",
        "CAST(NULL AS BIGINT) AS accepted_answer",
        "CAST(l_orderkey AS BIGINT) AS parent_id",
        "CAST(floor(l_extendedprice / 100) AS INT) AS score",
        "CAST(NULL AS STRING) AS tags",
    )
    return questions.unionByName(answers)


def posting_lines(postings: DataFrame) -> DataFrame:
    """Postings -> CSV ``value`` lines, NULL written as an empty field."""
    fields = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in POSTING_COLUMNS)
    return postings.selectExpr(f"concat_ws(',', {fields}) AS value")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings_from_tables(adapter_table(spark, sf_dir, "orders"),
                                adapter_table(spark, sf_dir, "lineitem"))
