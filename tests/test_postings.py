import pytest

from tessera.fixed import LANG_SPREAD, LANGS
from tessera.operators import postings as P

SCHEMA = ("posting_type int, id long, accepted_answer long, parent_id long, "
          "score int, tags string")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_tag_index_of_cpp(spark):
    df = spark.createDataFrame([("C++",), (None,), ("Cobol",), ("Java",)], "tags string")
    got = [r["lang_index"] for r in P.tag_index(df, LANGS).collect()]
    assert got == [5, None, -1, 1]


def test_tag_is_matched_whole(spark):
    df = spark.createDataFrame([("Java;Scala",)], "tags string")
    assert P.tag_index(df, LANGS).first()["lang_index"] == -1


def test_join_drops_unmatched(spark):
    df = frame(spark, [
        (1, 1, None, None, 3, "Java"),       # answered
        (1, 2, None, None, 3, "Scala"),      # no answers
        (2, 10, None, 1, 7, None),
        (2, 11, None, 1, 9, None),
        (2, 12, None, None, 100, None),      # answer without a parent
        (2, 13, None, 99, 100, None),        # parent that does not exist
    ])
    pairs = P.question_answer_pairs(df)
    assert sorted((r["qid"], r["a_id"]) for r in pairs.collect()) == [(1, 10), (1, 11)]
    assert [(r["qid"], r["n_pairs"]) for r in P.pair_counts(df).collect()] == [(1, 2)]
    (group,) = P.grouped_postings(df).collect()
    assert (group["qid"], group["chunk"], [(p["question"]["id"], p["answer"]["id"], p["n"]) for p in group["pairs"]]) == (1, 0, [(1, 10, 1), (1, 11, 1)])
    scored = P.scored_postings(df).collect()
    assert [(r["id"], r["high_score"]) for r in scored] == [(1, 9)]


def test_identical_questions_merge_distinct_ones_stay(spark):
    df = frame(spark, [
        (1, 1, None, None, 3, "Java"),
        (1, 1, None, None, 3, "Java"),        # identical copy -> merges
        (1, 1, None, None, 4, "Java"),        # same id, other score -> separate
        (2, 10, None, 1, 7, None),
    ])
    got = sorted((r["score"], r["high_score"]) for r in P.scored_postings(df).collect())
    assert got == [(3, 7), (4, 7)]


def test_null_fields_group_as_equal(spark):
    df = frame(spark, [
        (1, 1, None, None, 3, None),
        (1, 1, None, None, 3, None),
        (2, 10, None, 1, 7, None),
        (2, 11, None, 1, -2, None),
    ])
    rows = P.scored_postings(df).collect()
    assert [(r["id"], r["tags"], r["high_score"]) for r in rows] == [(1, None, 7)]


def test_scored_matches_join_then_regroup(spark):
    """The pre-aggregated plan equals the original join -> regroup -> max."""
    import random

    from pyspark.sql import functions as F
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        if rnd.random() < 0.4:
            rows.append((1, rnd.randint(1, 30), rnd.choice([None, 5]), None, rnd.randint(0, 2),
                         rnd.choice([None, "Java", "Scala", "x"])))
        else:
            rows.append((2, rnd.randint(100, 200), None, rnd.choice([None, *range(1, 35)]),
                         rnd.randint(-5, 50), None))
    df = frame(spark, rows)
    pairs = P.question_answer_pairs(df)
    qcols = [f"q_{c}" for c in ("posting_type", "id", "accepted_answer", "parent_id", "score", "tags")]
    expect = pairs.groupBy(*qcols).agg(F.max("a_score").alias("hs")).collect()
    got = P.scored_postings(df).collect()
    assert sorted(map(tuple, expect), key=repr) == sorted(map(tuple, got), key=repr)


def test_vectors(spark):
    scored = spark.createDataFrame(
        [(1, "C++", 7), (2, None, 3), (3, "Cobol", 4)], "id long, tags string, high_score int")
    got = [(r["id"], r["x"], r["y"]) for r in P.vector_postings(scored, LANGS).collect()]
    assert got == [(1, 5 * LANG_SPREAD, 7), (2, 0, 3), (3, -LANG_SPREAD, 4)]
    dropped = P.vector_postings(scored, LANGS, unknown="drop").collect()
    assert [r["id"] for r in dropped] == [1, 2]


def test_vectors_bad_spread(spark):
    scored = spark.createDataFrame([(1, "C++", 7)], "id long, tags string, high_score int")
    with pytest.raises(ValueError):
        P.vector_postings(scored, LANGS, spread=0)


def test_grouped_counts_equal_join_pairs(spark):
    import random
    rnd = random.Random(11)
    rows = [(1, rnd.randint(1, 20), None, None, 0, None) for _ in range(60)]       # duplicate ids
    rows += [(2, 1000 + i, None, rnd.choice([None, *range(1, 25)]), i, None) for i in range(200)]
    df = frame(spark, rows)
    expect = P.question_answer_pairs(df).groupBy("qid").count().collect()
    got = P.pair_counts(df).collect()
    assert sorted((r["qid"], r["count"]) for r in expect) == sorted((r["qid"], r["n_pairs"]) for r in got)


def test_tag_index_long_term_lists(spark):
    many = list(LANGS) + [f"t{i}" for i in range(P.INLINE_TERMS_MAX)]
    df = spark.createDataFrame([("C++",), (None,), ("Cobol",), ("t7",)], "tags string")
    got = sorted(((r["tags"] or ""), r["lang_index"]) for r in P.tag_index(df, many).collect())
    assert got == [("", None), ("C++", 5), ("Cobol", -1), ("t7", len(LANGS) + 7)]
    scored = spark.createDataFrame([(1, "C++", 7), (2, None, 3), (3, "t0", 4)],
                                   "id long, tags string, high_score int")
    got = sorted(tuple(r) for r in P.vector_postings(scored, many, spread=10).collect())
    assert got == [(1, 50, 7), (2, 0, 3), (3, 10 * len(LANGS), 4)]


def test_vectors_reject_overflowing_spread(spark):
    scored = spark.createDataFrame([(1, "t1", 7)], "id long, tags string, high_score int")
    with pytest.raises(ValueError):
        P.vector_postings(scored, [f"t{i}" for i in range(50_000)], spread=50_000)
