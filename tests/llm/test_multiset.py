import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import multiset, queries


def brute_edits(rows):
    """doc_id -> (n_chars, edited sha256) by the definition; ids are unique here."""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        follower = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        out[i] = (len(t), hashlib.sha256((t[:len(t) - q] + follower[:q]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("range_bytes", [500, 20_000, 32 << 20])
def test_edited_texts_of_a_whole_table(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(multiset, "RANGE_BYTES", range_bytes)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_edits([(r.doc_id, r.text) for r in docs.collect()])
    rows = queries.op6_fingerprints(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == want
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {}
    for r in rows:
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)
    closer = sum(r.near_edited > r.near_next for r in rows)
    assert closer > 0.9 * len(rows)


def test_edges(spark):
    rows = [(3, "x. y. z."), (1, None), (2, ""), (9, "é😀é😀é"), (7, "long text. " * 3000)]
    got = {r.id: r for r in multiset.compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_edits(rows)
    assert {i: (len(r.text), hashlib.sha256(r.edited.encode()).hexdigest()) for i, r in got.items()} == want
    assert got[1].near_next == 1.0 and got[2].near_next == 0.0      # empty beside empty; empty beside text
    alone = multiset.compare_edits(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).collect()
    assert [r.edited for r in alone] == ["abcdefab"]
    assert multiset.compare_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("range_bytes", [1, 32 << 20])
def test_repeated_and_null_ids_keep_their_rows(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(multiset, "RANGE_BYTES", range_bytes)
    rows = [(4, "a"), (4, "a"), (4, "bbbb"), (None, "null one"), (None, "null two"), (5, None)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, vec string, range int, ghost int")
    out = multiset.compare_edits(df).collect()
    assert sorted((str(r.id), r.text) for r in out) == sorted((str(i), t or "") for i, t in rows)


def test_order_and_increments(spark):
    t = spark.createDataFrame([("A one.\nB two.\nB two.", "B two. A one. B two.", "A one.", "B two.\nB two.")],
                              "a string, b string, one string, two string")
    v = {c: multiset.vector(F.col(c)) for c in t.columns}
    r = t.select((v["a"] == v["b"]).alias("same"), (multiset.insert(v["one"], v["two"]) == v["a"]).alias("ins"),
                 (multiset.delete(v["a"], v["one"]) == v["two"]).alias("del"), (v["one"] == v["two"]).alias("other")).first()
    assert (r["same"], r["ins"], r["del"], r["other"]) == (True, True, True, False)
