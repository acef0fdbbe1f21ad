"""Preparing a training corpus from the documents table, stage by stage.

``STAGES`` lists (name, function) pairs; each function takes the session, the
documents its predecessor kept and the folder of the tables, and returns a
DataFrame that is written as Parquet and read again by the next one.  All but
the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixture, pieces, secrets, simhash, toxicity
from tessera.llm.common import crc_mod
from tessera.session import checkpoint_dir, remove_table


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; learned from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, keep=crc_mod(F.col("doc_id"), 4) != 2)
    return toxicity.drop_toxic(docs, model)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (3-word shingles, 2 bits)."""
    return simhash.keep_one(docs)


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secrets.redact(docs)


def stage_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights, in the order of training."""
    return mixture.mix(docs)


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that the mix takes, in its order."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("simhash_near_dedup", stage_simhash),
    ("secret_scans", stage_secrets),
    ("source_mixture", stage_mixture),
    ("sentencepiece", stage_sentencepiece),
]

# SQL cannot express a trained model, a randomness battery or a Viterbi search;
# tests/llm/test_pipeline.py compares run() with a brute-force version
ORACLE_SQL = None


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether the stage that writes ``path`` has finished: its mark is there."""
    try:
        return spark.read.parquet(f"{path}-done").count() == 1
    except AnalysisException:       # no such path
        return False


def run(spark: SparkSession, sf_dir: str, run_id: str | None = None) -> DataFrame:
    """All stages over ``{sf_dir}/documents.parquet``.

    The tables between the stages are written in the shared checkpoint folder;
    each is deleted once the next one is complete, and the last one stays.  A
    run that failed goes on behind its last complete stage when it is called
    again with its ``run_id``; without one every run is a new one.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{run_id or uuid.uuid4().hex}"
    paths = [f"{base}/{k}-{name}" for k, (name, _) in enumerate(STAGES)]
    done = 0 if run_id is None else max((k + 1 for k, path in enumerate(paths) if _complete(spark, path)), default=0)
    docs = spark.read.parquet(paths[done - 1] if done else f"{sf_dir}/documents.parquet")
    for k in range(done, len(STAGES)):
        # what a stage left that was cut off is written over
        STAGES[k][1](spark, docs, sf_dir).write.mode("overwrite").parquet(paths[k])
        spark.range(1).write.mode("overwrite").parquet(f"{paths[k]}-done")
        docs = spark.read.parquet(paths[k])
        if k:
            remove_table(spark, paths[k - 1])
    return docs
