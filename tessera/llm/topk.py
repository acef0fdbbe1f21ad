"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

A vector's components are terms with integer weights.  Queries and candidates
are dealt into blocks of fixed size, and every pair of a query block and a
candidate block is one group: for each term, the posting list of the
candidates with that term is scattered, weighted by the queries that have it,
into the queries' dense score arrays.  Each block then gives its k best per
query by partition selection, and a rank-limited window merges the blocks.
The work is the product of queries and candidates, as the search is exhaustive;
no group is larger than one block of either side.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut

SCALE = 1024
K = 10
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192


def integer_weights(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null if the vector is null or has a
    null or non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of a block; shorter vectors lack their last terms."""
    rows = [np.asarray(v, dtype=np.int64) for v in vectors]
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _block_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores (queries x candidates), accumulated term by term from postings."""
    scores = np.zeros((len(queries), len(candidates)), dtype=np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        having = np.flatnonzero(queries[:, term])
        posting = np.flatnonzero(candidates[:, term])
        if not len(having) or not len(posting):
            continue
        weights = candidates[posting, term]
        if len(posting) == len(candidates):
            for q in having:
                scores[q] += queries[q, term] * weights
        else:
            for q in having:
                scores[q, posting] += queries[q, term] * weights
    return scores


def _best(row: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, the first positions among equal ones."""
    at = np.flatnonzero(allowed)
    if len(at) <= k:
        return at
    values = row[at]
    edge = np.partition(values, len(values) - k)[len(values) - k]
    above = np.flatnonzero(values > edge)
    level = np.flatnonzero(values == edge)[:k - len(above)]
    return at[np.concatenate([above, level])]


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``(query_id, rank, id, score)``: each query's k best candidates, all if there are fewer.

    Queries are the rows where ``is_query`` (a condition on ``id``) holds,
    candidates all rows but the query's own; rows that repeat an id are queries
    and candidates of their own.  Equal scores go to the smaller id.  Vectors
    that are null or hold null or non-finite components take no part, nor do
    rows with a null id.  Vectors may differ in length: a missing component is
    zero.  Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), integer_weights(F.col(vector_col), scale).alias("w"))
    # the checkpoint fixes the rows' keys
    rows = cut(rows.where("id is not null and w is not null").withColumn("q", is_query).withColumn("key", F.monotonically_increasing_id()))
    n, n_queries = rows.agg(F.count("*"), F.count_if("q")).first()
    c_blocks, q_blocks = max(1, math.ceil(n / candidate_block)), max(1, math.ceil(n_queries / query_block))

    def block(seed: int, blocks: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    queries = rows.where("q").select("key", "id", "w", block(1, q_blocks).alias("qb"), every(c_blocks).alias("cb"))
    candidates = rows.select("key", "id", "w", block(2, c_blocks).alias("cb"), every(q_blocks).alias("qb"))

    def search(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        query, of, keys, ids, scores = [], [], [], [], []
        if len(qs) and len(cs):
            cs = cs.sort_values(["id", "key"])
            c_keys, c_ids = cs["key"].to_numpy(), cs["id"].to_numpy()
            table = _block_scores(_matrix(qs["w"]), _matrix(cs["w"]))
            for q, (own, of_id) in enumerate(zip(qs["key"].to_numpy(), qs["id"].to_numpy())):
                at = _best(table[q], c_keys != own, k)
                query.append(np.full(len(at), own))
                of.append(np.full(len(at), of_id))
                keys.append(c_keys[at])
                ids.append(c_ids[at])
                scores.append(table[q][at])
        empty = [np.zeros(0, np.int64)]
        return pd.DataFrame({"query": np.concatenate(query or empty), "query_id": np.concatenate(of or empty), "key": np.concatenate(keys or empty),
                             "id": np.concatenate(ids or empty), "score": np.concatenate(scores or empty)})

    found = (queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
             .applyInPandas(search, "query long, query_id long, key long, id long, score long"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
