"""The Merkle manifest against a recursive version on Python lists."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.llm import merkle, queries
from tests.oracle import compare, duck_connection

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def walk(tree, i):
    for level in tree[:-1]:
        first = i // 8 * 8
        yield level[first:i], level[i + 1:first + 8]
        i //= 8


def expected(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: levels([x[2] for x in sorted(by_lang[v], key=lambda x: x[:3])]) for v in langs}
    top = levels([trees[v][-1][0] for v in langs])
    out = []
    for at, v in enumerate(langs):
        for i, (_, _, digest, r) in enumerate(sorted(by_lang[v], key=lambda x: x[:3])):
            steps = [*walk(trees[v], i), *walk(top, at)]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if changed else r[1]
            value = leaf((r[0], text, *r[2:]))
            for before, behind in steps:
                value = sha("".join(before) + value + "".join(behind))
            proof = sha("".join("".join(a) + "".join(b) for a, b in steps))
            out.append((r[0], digest, trees[v][-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(out, key=repr)


def some_rows(n, seed=1):
    rng = random.Random(seed)
    langs = ["en"] * 6 + ["de", "fr", "Ünï", "", None]
    rows = [(i, rng.choice(["Some Text", "lower text", "", None, "ÄÖ É"]) , rng.choice(langs), rng.choice(["a", None, "b:1"]),
             rng.choice([3, None, -7])) for i in range(n)]
    # repeated rows, repeated and null ids
    return rows + rows[:5] + [(3, "Other", "en", "a", 1), (None, "Null Id", "en", None, 1), (None, None, None, None, None)]


def found(spark, rows, height, monkeypatch):
    monkeypatch.setattr(queries, "_table", lambda *a: spark.createDataFrame(rows, SCHEMA))
    monkeypatch.setattr(merkle.manifest, "__defaults__", (height,))
    return sorted(map(tuple, queries.op12_merkle(spark, "").collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 4])
def test_equals_lists_at_any_block_height(spark, monkeypatch, height):
    rows = some_rows(400)
    assert found(spark, rows, height, monkeypatch) == expected(rows)


def test_many_groups_and_single_leaves(spark, monkeypatch):
    rows = [(i, f"Text {i}", f"l{i % 70}", None, i) for i in range(90)]
    assert found(spark, rows, 1, monkeypatch) == expected(rows)
    assert found(spark, rows[:1], 1, monkeypatch) == expected(rows[:1])


def test_empty_table(spark, monkeypatch):
    assert found(spark, [], 4, monkeypatch) == []


def test_clashing_columns_are_carried(spark):
    rows = spark.range(20).select(F.lit("g").alias("group"), F.col("id"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"),
                                  F.col("id").alias("block"), F.lit("x").alias("height"), F.lit(1.5).alias("subroots"))
    made = merkle.manifest(rows, 1)
    got = merkle.audit(made, carry=("block", "height", "subroots"))
    assert got.columns == ["block", "height", "subroots", "digest", "subroot", "root", "proof_sha256", "folded_root"]
    assert got.where("folded_root = root").count() == 20
    assert made.root == levels([levels([sha(str(i)) for i in range(20)])[-1][0]])[-1][0]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_layout_is_a_bijection_split_at_half_height(n):
    at = [merkle.veb_address(n, d, np.arange(8 ** d)) for d in range(n)]
    assert sorted(np.concatenate(at).tolist()) == list(range(merkle.tree_size(n)))
    top = n // 2
    if top:
        # the upper half comes first, then each lower subtree as a whole
        assert max(a.max() for a in at[:top]) == merkle.tree_size(top) - 1
        below = np.concatenate([a.reshape(8 ** top, -1) for a in at[top:]], axis=1)
        size = merkle.tree_size(n - top)
        assert below.min(axis=1).tolist() == [merkle.tree_size(top) + i * size for i in range(8 ** top)]
        assert (below.max(axis=1) - below.min(axis=1) == size - 1).all()


def test_written_blocks_give_the_siblings_back(spark, tmp_path):
    digests = [sha(str(i)) for i in range(100)]
    rows = spark.createDataFrame([("g", i, d) for i, d in enumerate(digests)], "group string, id long, digest string")
    merkle.manifest(rows, 2).write(str(tmp_path / "m"))
    stored = {(r["level"], r["block"]): r for r in spark.read.parquet(str(tmp_path / "m" / "groups")).collect()}
    assert sorted(stored) == [(0, 0), (0, 1), (1, 0)]
    r = stored[0, 1]
    block = merkle.Block.load(r["height"], r["count"], bytes(r["nodes"]))
    steps = [*block.siblings(99 - 64)]
    top = stored[1, 0]
    steps += [*merkle.Block.load(top["height"], top["count"], bytes(top["nodes"])).siblings(1)]
    assert [a + b for a, b in steps] == ["".join(a) + "".join(b) for a, b in walk(levels(digests), 99)]


def test_matches_oracle(spark):
    sf = "/root/testdata/sf0.01"
    r = compare(E.queries()["op12_merkle"](spark, sf), duck_connection(sf), E.oracle_sql()["op12_merkle"])
    assert r["ok"], r
