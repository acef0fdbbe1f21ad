"""Incremental article ranking over a growing folder of article dumps.

The same operators as the batch job (line parser + combined mention count)
applied to a Structured Streaming text source: each new file is parsed, its
mentions are counted map-side, and the running count per term is kept in
the state store — one row per term, so state stays bounded by the term
list however much text arrives.  Output mode is ``complete`` (the whole,
small ranking is re-emitted each trigger).  Progress and state live under a
checkpoint location in the session's checkpoint folder, so a restarted
query resumes without recounting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.fixed import LANGS
from tessera.operators.ranking import mention_counts
from tessera.session import checkpoint_dir
from tessera.sources.articles import parse_article_lines


def article_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(title, text)`` from article dump files appearing under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_article_lines(reader.load(path))


def running_mention_counts(articles: DataFrame, terms: Sequence[str] = LANGS) -> DataFrame:
    """``(term, n)`` kept up to date as articles arrive, highest count first."""
    return mention_counts(articles, terms).orderBy(F.col("n").desc(), F.col("term"))


def start_ranking(spark: SparkSession, path: str, terms: Sequence[str] = LANGS,
                  query_name: str = "term_ranking", *, sink: str,
                  checkpoint_location: str | None = None, **sink_options) -> StreamingQuery:
    """Start the incremental ranking into a sink that takes complete results
    (the ``memory`` sink, for tests, is readable as ``spark.table(query_name)``).

    Progress and state go to ``checkpoint_location``, by default
    ``<checkpoint dir>/stream-<query_name>``: starting the same query name
    again resumes where it stopped: files already counted are not read again,
    and the restored running counts are re-emitted in full (complete mode) at
    the next trigger.
    """
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-{query_name}"
    writer = (running_mention_counts(article_stream(spark, path), terms).writeStream
              .outputMode("complete").format(sink).queryName(query_name)
              .option("checkpointLocation", location))
    for k, v in sink_options.items():
        writer = writer.option(k, v)
    return writer.start()
