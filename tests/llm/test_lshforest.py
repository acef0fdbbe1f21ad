"""MinHash near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.llm import lshforest

SCHEMA = "doc_id long, text string"


def shingles(text, n=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(rows):
    """``(doc_id, size, component)`` by union-find over all pairs of different sets."""
    sets = [shingles(t) for _, t in rows]
    distinct = sorted(set(sets) - {frozenset()}, key=lambda s: (len(s), sorted(s)))
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    where = {}
    for i, s in enumerate(distinct):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(distinct):
        for j in {j for x in s for j in where[x] if j < i}:
            both = len(s & distinct[j])
            if 100 * both >= 80 * (len(s) + len(distinct[j]) - both):
                parent[find(s)] = find(distinct[j])
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            r = find(s)
            least[r] = min(i, least.get(r, i))
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets)), key=repr)


def found(spark, rows, **how):
    got = lshforest.near_duplicates(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted(map(tuple, got.collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.choice([0, 1])] = [f"x{rng.randrange(10 ** 6)}"]
    return words


def corpus(seed, groups=40):
    """Originals with exact, cased and edited copies, chains of edits and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for g in range(groups):
        words = rng.choices(vocabulary, k=rng.choice([3, 30, 120, 200]))
        if g % 3 == 0:
            words += passage
        texts.append(words)
        if len(words) > 20:
            for _ in range(rng.randrange(6)):
                texts.append(edited(rng, words, rng.randrange(1, 6)))
            chain = words
            for _ in range(rng.randrange(4)):
                chain = edited(rng, chain, 2)
                texts.append(chain)
        texts.append([w.upper() for w in words])
    rng.shuffle(texts)
    seps = [" ", "\n", "\t ", " \x0b\f\r"]
    return [(i, rng.choice(seps).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute_force(rows)


def test_crowded_regions_lose_no_component(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(4000)}" for _ in range(150)]
    # near copies of one text, many of them linked to some of the others only
    rows = [(1000 + i, " ".join(edited(rng, words, rng.randrange(1, 9)))) for i in range(150)]
    assert found(spark, rows, region=4) == brute_force(rows)


def test_odd_rows(spark):
    long = " ".join(f"t{i % 977} u{i}" for i in range(60_000))
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "one"), (2, "ONE"), (8, "one two"), (7, "one  two"), (6, "one two three four"),
            (1, "one two three"), (None, "a b c d e f"), (11, "a b c d e f"), (12, "É é"), (13, "é é"), (20, long), (21, long + " end"),
            (9, "one"), (30, "x y z x y z x y z x"), (None, None), (None, "only nulls have this"), (40, "a b"), (41, "a b")]
    assert found(spark, rows) == brute_force(rows)


def test_repeated_rows_and_an_empty_table(spark):
    rows = corpus(5, 12)
    rows = rows + rows[:20] + [rows[0]] * 30
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, []) == []


def test_clashing_columns_are_ignored(spark):
    rows = corpus(6, 8)
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("id", "sid", "n", "sig", "comp", "key", "u")])
    assert sorted(map(tuple, lshforest.near_duplicates(frame).collect()), key=repr) == brute_force(rows)


def test_signatures_estimate_the_likeness():
    rng = np.random.default_rng(0)
    a, b = lshforest._odd(128, 20), lshforest._odd(128, 21)
    errors = []
    for both in (0.2, 0.5, 0.8, 0.95):
        for _ in range(50):
            x = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
            k = int(400 * 2 * both / (1 + both))
            y = np.concatenate([x[:k], rng.integers(0, 1 << 63, 400 - k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
            p, q = (np.frombuffer(lshforest.signature(np.sort(s), a, b), np.uint32) for s in (x, y))
            errors.append((p == q).mean() - k / (800 - k))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_whole_table_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = E.queries()["op11_minhash"](spark, sf).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_force(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_cells_carry_one_byte_of_each_minhash(spark):
    """Regions are searched without whole signatures, and no pair agrees less by its bytes."""
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 32, lshforest.TREES * lshforest.DEPTH, np.uint64).astype(">u4") for _ in range(2))
    near = np.where(np.arange(len(a)) % 4 == 3, b, a)
    sigs = {1: a.tobytes(), 2: near.astype(">u4").tobytes(), 3: a.tobytes()}
    sets = spark.createDataFrame([(i, 100, bytearray(s)) for i, s in sigs.items()], "sid long, n long, sig binary")
    placed = lshforest._placed(sets, sets.select("sid", F.col("sid").alias("comp")))
    cells = lshforest._cells(placed, sets, 500)
    got = {(r.sid, bytes(r.sig)) for r in cells.collect()}
    assert {i for i, _ in got} >= {1, 3} and got <= {(i, s[3::4]) for i, s in sigs.items()}
    assert {r.sid for r in lshforest._involved(cells).collect()} >= {1, 3}
    whole = np.mean(near == a)
    assert np.mean(np.frombuffer(sigs[2][3::4], np.uint8) == np.frombuffer(sigs[1][3::4], np.uint8)) >= whole
