"""Registered queries of this subpackage, by the results they return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, licenses, lm, lshforest, merkle, mixture, multiset, pieces, rtree, secrets, simhash, sql, topk, toxicity
from tessera.llm.common import ascii_lower, crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, at most 2 bits apart."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten highest integer inner products of every hundredth vector with all others."""
    found = topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's probability under the bit mixture, learned from nine folds of ten."""
    docs = _table(spark, sf_dir, "documents")
    train = crc_mod(F.col("doc_id"), 10) != 0
    return lm.score(docs, train).select(
        "doc_id", (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "bits_per_byte")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text by Viterbi search, decoded again and compared."""
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and verified licence templates of all documents."""
    found = licenses.find_licenses(_table(spark, sf_dir, "documents"))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.transform("base", lambda p: p["label"])
    at = F.transform("base", lambda p: p["at"])
    scores = F.transform("aligned", lambda a: a["score"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("aligned", lambda a: a["label"]))).alias("labels"),
        F.greatest(F.coalesce(F.array_max(scores), F.lit(0.0)),
                   F.when(F.size("base") > 0, licenses.BASE_SCORE).otherwise(0.0)).alias("score"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset-hash fingerprints of all documents and of their edited texts."""
    rows = multiset.compare_edits(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), multiset.to_hex(F.col("vec")).alias("fingerprint"),
                       multiset.to_hex(F.col("edited_vec")).alias("edited_fingerprint"), "near_edited", "near_next")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents: the fixed kinds and the randomness battery's."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.digest(F.col("base")), 256).alias("base_sha256"),
                        secrets.digest(F.col("spans")).alias("spans"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of every document."""
    return mixture.plan(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from two folds of three."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, keep=crc_mod(F.col("doc_id"), 3) != 1)
    return langid.predict(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labels of three folds of four."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), keep=crc_mod(F.col("doc_id"), 4) != 2)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 4-word shingles, Jaccard 0.8 or more."""
    found = lshforest.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents in the manifest; a third of the texts are lower-cased before they are folded."""
    docs = _table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in merkle.COLUMNS}
    lowered = merkle.leaf_digest(fields | {"text": ascii_lower(F.col("text"))})
    leaf = merkle.leaf_digest(fields)
    rows = docs.select("doc_id", F.col("lang").alias("group"), F.col("doc_id").alias("id"), leaf.alias("digest"),
                       F.when(crc_mod(F.col("doc_id"), 3) == 0, lowered).otherwise(leaf).alias("tampered"))
    proved = merkle.audit(merkle.manifest(rows), "tampered", ("doc_id",))
    return proved.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; a seventh of the labels are shifted first."""
    vectors = _table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return rtree.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_topk": op2_topk,
        "op3_lm": op3_lm,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_licenses": op5_licenses,
        "op6_fingerprints": op6_fingerprints,
        "op7_secrets": op7_secrets,
        "op8_mixture": op8_mixture,
        "op9_language": op9_language,
        "op10_toxicity": op10_toxicity,
        "op11_minhash": op11_minhash,
        "op12_merkle": op12_merkle,
        "op13_negatives": op13_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": sql.TOP_K, "op8_mixture": sql.MIXTURE, "op12_merkle": sql.MERKLE, "op13_negatives": sql.HARD_NEGATIVES}
