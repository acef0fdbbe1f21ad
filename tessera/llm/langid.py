"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes a normalised vector of hashed byte pairs and triples of its
lower-cased letters.  Document frequencies come from all training texts; on a
bounded sample of each language's texts (about ``SAMPLE_DOCS``, drawn by hash)
a spherical k-means gives several centroids per language.  A text gets the
language of the centroid with the largest cosine; it is marked as rejected if
it is farther from that centroid than nearly all of the language's own texts.

Every language is clustered in a task of its own; what the tasks share is one
frequency per hash bucket and ``CLUSTERS`` vectors per language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
CLUSTERS = 4
SAMPLE_DOCS = 600
ROUNDS = 10
REJECT_SHARE = 0.005     # own texts of a language that its radius leaves out
SHARPNESS = 25.0         # of the softmax over languages that gives the score
UNDETERMINED = "und"

LETTER = re.compile(r"[^\W\d_]")
# bytes of ASCII letters and of all other characters stay, the rest are spaces
KEPT = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the text's byte pairs and triples, and how often each occurs."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(KEPT) + b" ", dtype=np.uint8).astype(np.uint32)
    pairs = b[:-1] * np.uint32(257) + b[1:]
    triples = pairs[:-1] * np.uint32(263) + b[2:] + np.uint32(1)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for codes in (pairs, triples):
        codes = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
        counts += np.bincount(codes, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = term_counts(text)
    value = (1 + np.log(n)) * idf[at]
    norm = np.sqrt((value * value).sum())
    return at, (value / norm if norm > 0 else value).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    idf: np.ndarray             # per bucket
    languages: list[str]        # of every centroid
    centroids: np.ndarray       # buckets x centroids
    radius: np.ndarray          # least cosine of a centroid's language that is not rejected

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not LETTER.search(text) or not self.languages:
            return UNDETERMINED, 0.0, True
        at, value = _vector(text, self.idf)
        cosine = value @ self.centroids[at]
        best = int(np.argmax(cosine))
        by_language: dict[str, float] = {}
        for name, c in zip(self.languages, cosine.tolist()):
            by_language[name] = max(c, by_language.get(name, -1.0))
        share = np.exp(SHARPNESS * (np.array(list(by_language.values())) - cosine[best]))
        rejected = bool(cosine[best] < self.radius[best])
        return self.languages[best], float(1 / share.sum() * (0.5 if rejected else 1.0)), rejected


def _cluster(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, float]:
    """Centroids of one language's texts and its radius."""
    x = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for i, t in enumerate(texts):
        at, value = _vector(t, idf)
        x[i, at] = value
    mean = x.mean(axis=0)
    # farthest-first seeds, from the text nearest to the mean
    seeds = [int(np.argmax(x @ mean))]
    nearest = x @ x[seeds[0]]
    while len(seeds) < min(CLUSTERS, len(texts)):
        seeds.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[seeds[-1]])
    centroids = x[seeds]
    for _ in range(ROUNDS):
        owner = np.argmax(x @ centroids.T, axis=1)
        sums = np.stack([x[owner == k].sum(axis=0) for k in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centroids)
        done = np.allclose(moved, centroids, atol=1e-6)
        centroids = moved.astype(np.float32)
        if done:
            break
    own = np.sort((x @ centroids.T).max(axis=1))
    # half of the distance again, as unseen texts lie farther out than the clustered ones
    edge = own[int(REJECT_SHARE * len(own))]
    return centroids, float(1 - 1.5 * (1 - edge))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          keep: Column | None = None) -> LanguageModel:
    """Learn the non-null languages of ``docs`` (of the rows where ``keep`` holds).

    Texts without a letter teach nothing.  A table without any such row gives a
    model that leaves every text undetermined.
    """
    rows = docs if keep is None else docs.where(keep)
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS, dtype=np.int64)
        langs: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if LETTER.search(text):
                    df[term_counts(text)[0]] += 1
                    langs[lang] = langs.get(lang, 0) + 1
        at = np.flatnonzero(df)
        # bucket -1 carries the number of texts of a language
        yield pa.RecordBatch.from_arrays([
            pa.array([""] * len(at) + list(langs), pa.string()),
            pa.array(np.concatenate([at, np.full(len(langs), -1)]).astype(np.int64)),
            pa.array(np.concatenate([df[at], np.array(list(langs.values()), dtype=np.int64)]).astype(np.int64))],
            names=["lang", "bucket", "n"])

    counted = (rows.select("text", "lang").mapInArrow(frequencies, "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())      # buckets + languages
    sizes = {r["lang"]: r["n"] for r in counted if r["bucket"] < 0}
    total = sum(sizes.values())
    df = np.zeros(BUCKETS)
    for r in counted:
        if r["bucket"] >= 0:
            df[r["bucket"]] = r["n"]
    idf = (np.log((total + 1) / (df + 1)) + 1).astype(np.float32)
    if not sizes:
        return LanguageModel(idf, [], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) / 1_000_000
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, SAMPLE_DOCS / n))).otherwise(rate)
    sample = rows.where(draw < rate)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group[[bool(LETTER.search(t)) for t in group["text"]]].sort_values(["id", "text"])
        if not len(group):
            return pd.DataFrame(columns=["lang", "k", "radius", "vector"])
        centroids, radius = _cluster(list(group["text"]), idf)
        return pd.DataFrame({"lang": pd.Series([group["lang"].iloc[0]] * len(centroids), dtype=object), "k": range(len(centroids)), "radius": radius,
                             "vector": [c.astype("<f4").tobytes() for c in centroids]})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, k int, radius double, vector binary").collect()
    found.sort(key=lambda r: (r["lang"], r["k"]))
    centroids = np.stack([np.frombuffer(r["vector"], "<f4") for r in found], axis=1) if found else np.zeros((BUCKETS, 0), np.float32)
    return LanguageModel(idf, [r["lang"] for r in found], np.ascontiguousarray(centroids), np.array([r["radius"] for r in found]))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score, rejected)`` for every row; only the text is looked at.

    Null texts and texts without a letter are ``und`` with score 0.  Repeated
    rows stay; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_())], names=[id_col, "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, schema)
