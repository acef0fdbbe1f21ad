import math
import re
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tessera.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(4)
    calm = ["the", "tree", "river", "stone", "green", "walk", "under", "identity", "stupor", "clover", "idle", "sound", "warm", "garden"]
    bad = ["idiot", "stupid", "moron", "clown"]
    text = lambda words, n: " ".join(rng.choice(words, n)) + "."
    clean = [text(calm, rng.integers(5, 60)) for _ in range(300)]
    toxic = [text(calm, 20) + " " + text(bad + calm[:2], 4) + " " + text(calm, 10) for _ in range(100)]
    toxic = [t for t in toxic if any(b in t for b in bad)]
    return toxicity.fit(toxic, clean)


def test_gapped_and_inserted_insults(spark, model):
    base = "the green river walk under the warm tree "
    rows = [(1, base + "you idiot"), (2, base + "you id*iot"), (3, base + "you i.d.i.o.t"), (4, base + "you i d i o t"), (5, base + "you idioot"),
            (6, base + "the clown"), (7, base + "identity"), (8, base + "stupor of the clover"), (9, base * 3000), (10, ""), (11, None), (12, " \n"),
            (13, base), (13, base)]
    df = spark.createDataFrame([(*r, 0.1, "d") for r in rows], "doc_id long, text string, score double, doc string")
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    flagged = {r.doc_id for r in got if r.score >= toxicity.THRESHOLD}
    assert {1, 2, 3, 4, 5, 6} <= flagged and not flagged & {7, 8, 9, 13}
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [7, 8, 9, 10, 11, 12, 13, 13]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_held_out_labels(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    score = np.array([r.score for r in held])
    toxic = np.array([labels[r.doc_id] == 1 for r in held])
    rank = score.argsort().argsort()
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() - 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.95
    assert (score[~toxic] >= 0.3).mean() < 0.05


def _peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_fitting_holds_blocks_of_bounded_size():
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(rng.choice(letters, 22)) for _ in range(3000)]
    marks = toxicity._Landmarks(words[:toxicity.LANDMARKS])
    # landmarks of many subsequences: all words by all of those were a gigabyte
    kernel, peak = _peak_mb(lambda: marks.kernel(words))
    assert peak < 60
    some = list(range(0, 3000, 701))
    assert np.allclose(kernel[some], marks.kernel([words[i] for i in some])) and np.allclose(np.diag(kernel[:160]), 1)
    _, peak = _peak_mb(lambda: toxicity.word_values(words, marks.collapse(np.ones(len(marks.rows)))))
    assert peak < 60


def test_a_word_of_many_texts_is_held_once():
    calm = [f"word{i}" for i in range(2000)]
    names = {}
    # texts that are made as they are read
    bags = toxicity._bags((" ".join(calm) for _ in range(100)), names)
    assert len(names) == 2000 and all(b == set(calm) for b in bags)
    assert len({id(w) for b in bags for w in b}) == 2000
    assert toxicity._bags(["", " ", "a"], {}) == [{"a"}]


def test_an_insult_far_into_a_long_word_is_learned(spark):
    rng = np.random.default_rng(6)
    calm = ["the", "tree", "river", "stone", "green", "walk", "under", "garden", "sound", "warm", "clover", "idle"]
    glued = lambda words, n: "".join(rng.choice(words, n))
    clean = [" ".join(rng.choice(calm, 20)) + " " + glued(calm, 12) for _ in range(200)]
    toxic = [" ".join(rng.choice(calm, 20)) + " " + glued(calm, 7) + "idiot" + glued(calm, 4) for _ in range(80)]
    model = toxicity.fit(toxic, clean)
    rows = [(i, "the river " + glued(calm, 8) + ("idiot" if i % 2 else "") + glued(calm, 5)) for i in range(40)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert np.mean([got[i] >= toxicity.THRESHOLD for i in range(1, 40, 2)]) >= 0.9
    assert np.mean([got[i] >= toxicity.THRESHOLD for i in range(0, 40, 2)]) <= 0.1


def plain_score(text, model):
    """A text's probability from every subsequence written out, sharing no code with the library."""
    low = (text or "").lower()
    words = set(low.split())
    for run in re.findall(r"(?<!\S)(?:\S ){2,}\S(?!\S)", low):
        words.add(run.replace(" ", ""))

    def code(three):
        h = (ord(three[0]) * 0x9E3779B1 + ord(three[1]) * 0x85EBCA77 + ord(three[2]) * 0xC2B2AE3D) % 2 ** 32
        h ^= h >> 15
        return h * 0x2C1B3C6D % 2 ** 32 >> 12

    def value_of_piece(p):
        features = Counter()
        for i, j, k in combinations(range(len(p)), 3):
            if k - i < 6:
                features[code((p[i], p[j], p[k]))] += 0.6 ** (k - i)
        norm = math.sqrt(sum(v * v for v in features.values()))
        return sum(v / norm * float(model.table[c]) for c, v in features.items()) if norm else 0.0

    def value(word):
        bare = re.sub(r"^\W+|\W+$", "", word)
        readings = {bare}
        if not bare.isalnum():
            readings.add(re.sub(r"[\W_]+", "", bare))
        best = -math.inf
        for r in readings:
            marked = "\x02" + r + "\x03"
            pieces = [marked] if len(marked) <= 24 else [marked[i:i + 24] for i in range(0, len(marked) - 12, 12)]
            best = max([best, *map(value_of_piece, pieces)])
        return best

    top = sorted((max(-2.0, value(w) + model.bias) for w in words), reverse=True)[:3]
    x = top + [-2.0] * (3 - len(top)) + [math.log1p(len(words)), 1.0]
    if not words:
        x = [-2.0] * 3 + [0.0, 1.0]
    z = sum(a * b for a, b in zip(x, model.weights.tolist()))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_equal_every_subsequence_written_out(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()
    texts = [r.text for r in docs] + ["", None, " \n", "i d i o t !", "(id-iot)", "_", "a b c", "x" * 200, "éÉ ß İ 漢字", "tree" * 30 + "idiot" + "river" * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    for i, t in enumerate(texts):
        assert math.isclose(got[i], plain_score(t, model), rel_tol=1e-4, abs_tol=1e-6), (i, t)


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, None)]):
        model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert toxicity.score(docs, model).first().score < toxicity.THRESHOLD


def test_kernel_is_one_for_itself_and_falls_with_gaps():
    marks = toxicity._Landmarks([toxicity._bare("idiot")])
    same, gap, far, other = marks.kernel([toxicity._bare(w) for w in ("idiot", "idxiot", "ixdxixoxt", "garden")])[:, 0]
    assert np.isclose(same, 1) and same > gap > far >= 0 and other < 0.1
