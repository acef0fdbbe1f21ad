import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import pieces, secrets, simhash, toxicity
from tessera.llm.common import crc_mod
from tests.llm.test_mixture import brute_targets
from tests.llm.test_secrets import brute_base
from tests.llm.test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returns, each one given what the one before it wrote."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scans", "source_mixture", "sentencepiece"]
    for docs in stages[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxicity_stage(spark, stages):
    docs, kept = stages[0], stages[1]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels, keep=crc_mod(F.col("doc_id"), 4) != 2)
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    # brute force: every text through the model on the driver
    import numpy as np
    for r in docs.collect():
        words = sorted(toxicity.text_words(r.text or ""))
        p = model.probability([toxicity.word_values(words, model.table)])[0]
        assert (r.doc_id in gone) == (p >= toxicity.THRESHOLD) or abs(p - toxicity.THRESHOLD) < 1e-6
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [i for i, t in toxic.items() if t == 0]
    assert np.mean([i in gone for i in clean]) < 0.03


def test_simhash_stage(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    groups = brute_groups([brute_print(t) for _, t in rows])
    least = {}
    for (i, _), g in zip(rows, groups):
        least.setdefault(g, i)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(least.values())


def test_secret_stage(stages):
    before, after = {r.doc_id: r for r in stages[2].collect()}, {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    random_spans = {r.doc_id: r.spans for r in secrets.find_secrets(stages[2]).collect()}
    for i, r in before.items():
        spans = sorted({(s, e) for s, _, _, e in brute_base(r.text)} | {(s.start, s.end) for s in random_spans[i]})
        text, at = "", 0
        for s, e in spans:
            if s >= at:
                text += r.text[at:s] + "[SECRET]"
            at = max(at, e)
        assert after[i].text == text + r.text[at:]
        assert not brute_base(after[i].text)
        assert after[i].n_chars == len(after[i].text) or not spans


def test_mixture_stage(stages):
    sizes, taken = {}, {}
    count = lambda t: len(t.split())
    for r in stages[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
    for r in stages[4].collect():
        taken[r.source] = taken.get(r.source, 0) + count(r.text)
    longest = max(count(r.text) for r in stages[3].collect())
    for s, target in brute_targets(sizes).items():
        assert target - 1 <= taken[s] <= target + longest


def test_sentencepiece_stage(spark, stages):
    rows = stages[5].collect()
    assert len(rows) == stages[4].count() and all(r.restored for r in rows)
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert all(r.text == texts[r.doc_id] for r in pieces.decode(stages[5]).collect())


def test_run_is_the_chain_of_stages(spark, stages):
    key = lambda r: (r.doc_id, r.n_tokens, tuple(r.token_ids))
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages[5].collect()))


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_simhash_is_called_with_its_contract():
    assert (simhash.SHINGLE, simhash.MAX_BITS) == (3, 2)


ODD = [
    (1, "the cat sat on the mat and the dog ran", "en", "a", 40, "x"), (1, "the cat sat on the mat and the dog ran", "en", "a", 40, "x"),
    (2, None, "en", "a", None, None), (3, "", None, None, 0, ""), (None, "a text without an id", "en", "b", 20, "y"),
    (None, "a text without an id", "en", "b", 20, "y"), (4, "word " * 30000, None, "b", None, "z"), (5, " \n\t ", "de", None, 4, "z"),
    (6, "key password=7602ad27cf5550de1c here", "en", "c", 36, "w"), (7, "you utter idiot and clown", "en", "c", 25, "v"),
    (8, "you utter moron and clown", "en", "a", 25, "v"),
]
ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, doc string"


def test_stages_with_odd_rows_and_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame(ODD, ODD_COLUMNS).selectExpr(
        "*", "doc AS id", "doc AS tie", "doc AS position", "doc AS text_hash", "doc AS base", "doc AS tested", "doc AS spans",
        "doc AS score", "doc AS fp", "doc AS passes", "doc AS size", "doc AS k_id", "doc AS changed")
    labels = [(i, None, int(i in (7, 8))) for i in range(1, 9)] + [(9, 1, None), (None, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    counts = []
    rows = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, str(tmp_path))
        out.write.parquet(str(tmp_path / f"{k}"))
        rows = spark.read.parquet(str(tmp_path / f"{k}"))
        counts.append(rows.count())
        if name != "sentencepiece":
            assert rows.columns == docs.columns
        if name == "toxicity":
            # texts without a word are never toxic
            assert {2, 3, 5} <= {r.doc_id for r in rows.collect()}
        if name == "secret_scans":
            assert [r.text for r in rows.collect() if r.doc_id == 6] in ([], ["key [SECRET] here"])
    assert counts[0] <= len(ODD) and counts[1] <= counts[0] and counts[2] == counts[1]
    assert all(r.restored for r in rows.collect())


def test_mixture_stage_repeats_are_equal_rows(spark):
    docs = spark.createDataFrame(ODD, ODD_COLUMNS)
    once = {str(tuple(r)) for r in docs.collect()}
    mixed = corpus_pipeline.stage_mixture(spark, docs, "").collect()
    assert {str(tuple(r)) for r in mixed} <= once


def test_a_failed_run_goes_on_behind_its_last_complete_stage(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    calls, broken = [], [True]

    def stage(name, least):
        def work(spark, docs, sf_dir):
            calls.append(name)
            if name == "c" and broken[0]:
                raise RuntimeError("an executor too many is gone")
            return docs.where(F.col("doc_id") >= least)
        return work

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, stage(n, k)) for k, n in enumerate("abcd")])
    run_id = f"test-{tmp_path.name}"
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, str(tmp_path), run_id)
    broken[0] = False
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path), run_id).collect()) == list(range(3, 20))
    assert calls == ["a", "b", "c", "c", "d"]
    # a finished run is only read; without an id everything runs
    assert corpus_pipeline.run(spark, str(tmp_path), run_id).count() == 17 and len(calls) == 5
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 17 and len(calls) == 9
