"""Hot keys: one key holding a third of the rows must not change any result."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.fixed import LANG_SPREAD
from tessera.operators import postings as P
from tessera.operators import ranking
from tessera.operators.kmeans import weighted_points
from tessera.operators.report import cluster_results
from tessera.operators.sampling import initial_means, stratum_picks

SCHEMA = ("posting_type int, id long, accepted_answer long, parent_id long, "
          "score int, tags string")


def test_hot_question(spark):
    rnd = random.Random(3)
    rows = [(1, 0, None, None, 1, "Java")] * 50                 # copies of one question
    rows += [(1, q, None, None, 2, "Scala") for q in range(1, 200)]
    rows += [(2, 10_000 + i, None, 0, rnd.randint(0, 10_000), None) for i in range(3000)]  # hot
    rows += [(2, 20_000 + i, None, rnd.randint(1, 199), rnd.randint(0, 50), None) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    pairs = P.question_answer_pairs(df)
    qcols = [c for c in pairs.columns if c.startswith("q_")]
    naive = {tuple(r[:-1]): r[-1] for r in pairs.groupBy(*qcols).agg(F.max("a_score")).collect()}
    got = {tuple(r[:-1]): r[-1] for r in P.scored_postings(df).collect()}
    assert got == naive
    counts = {r["qid"]: r["n_pairs"] for r in P.pair_counts(df).collect()}
    assert counts[0] == 50 * 3000
    assert counts == {r["qid"]: r["count"] for r in pairs.groupBy("qid").count().collect()}


def test_hot_question_is_grouped_in_bounded_chunks(spark):
    rows = [(1, q, None, None, 2, "Scala") for q in range(50)]
    rows += [(2, 10_000 + i, None, 0, i % 97, None) for i in range(5000)]
    rows += [(2, 20_000 + i, None, 1 + i % 49, i % 13, None) for i in range(490)] + [(2, 20_000, None, 1, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    groups = P.grouped_postings(df, pairs_per_chunk=100).collect()
    pairs = P.question_answer_pairs(df)
    assert sum(p["n"] for g in groups for p in g["pairs"]) == pairs.count() == 5491
    assert max(len(g["pairs"]) for g in groups) <= 100
    assert len({g["chunk"] for g in groups if g["qid"] == 0}) == sum(g["qid"] == 0 for g in groups) >= 50
    got = sorted((p["question"]["id"], p["answer"]["id"], p["n"]) for g in groups for p in g["pairs"])
    want = sorted((r["qid"], r["a_id"], r["count"]) for r in pairs.groupBy("qid", "a_id").count().collect())
    assert got == want
    assert all(g["chunk"] == 0 for g in groups if g["qid"] > 0)


def _pair_bags(groups, pairs):
    """The pairs of the chunks and those of the join, both as (question, answer) -> number."""
    got, want = Counter(), Counter()
    for g in groups:
        for p in g["pairs"]:
            assert p["question"]["id"] == p["answer"]["parent_id"] == g["qid"]
            got[tuple(p["question"]), tuple(p["answer"])] += p["n"]
    for r in pairs.collect():
        want[tuple(r[c] for c in pairs.columns if c.startswith("q_")), tuple(r[c] for c in pairs.columns if c.startswith("a_"))] += 1
    return got, want


@pytest.mark.parametrize("shape", ["many questions", "both", "small"])
@pytest.mark.parametrize("heavy", [50, 10 ** 6])
def test_chunks_are_bounded_on_both_sides(spark, shape, heavy):
    rnd = random.Random(5)
    if shape == "many questions":        # distinct questions of one id, one answer
        rows = [(1, 7, None, None, i, "Java") for i in range(3000)] + [(2, 1, None, 7, 5, None)]
        bound = 100
    elif shape == "both":
        rows = [(1, 7, None, None, i, "Java") for i in range(60)] + [(2, i, None, 7, i % 9, None) for i in range(150)]
        rows += rows[:20] + rows[-30:]
        bound = 37
    else:
        rows = [(1, rnd.randrange(20), None, None, rnd.randrange(3), rnd.choice([None, "", "a"])) for _ in range(80)]
        rows += [(2, rnd.randrange(50), rnd.choice([None, 1]), rnd.choice([None, *range(22)]), rnd.randrange(4), None) for _ in range(300)]
        bound = 4
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    groups = P.grouped_postings(df, bound, heavy_rows=heavy).collect()
    assert max(len(g["pairs"]) for g in groups) <= bound
    assert len({(g["qid"], g["chunk"]) for g in groups}) == len(groups)
    got, want = _pair_bags(groups, P.question_answer_pairs(df))
    assert got == want
    pairs_of = Counter()
    for g in groups:
        pairs_of[g["qid"]] += len(g["pairs"])
    assert all(g["chunk"] == 0 for g in groups if pairs_of[g["qid"]] == len(g["pairs"]))
    # chunks are filled: not far more of them than the pairs need
    assert len(groups) <= sum(1 if n <= bound else 12 * n / bound + 4 for n in pairs_of.values())


def _no_adaptive_help(spark, run):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot_postings(spark, n, hot_questions):
    """A third of the answers belong to id 0; of the questions one or a third do."""
    return spark.range(n).selectExpr(
        "CAST(CASE WHEN id % 10 = 0 THEN 1 ELSE 2 END AS INT) AS posting_type",
        f"CASE WHEN id % 10 = 0 THEN {'IF(id % 30 = 0, 0, id)' if hot_questions else 'id'} ELSE id END AS id",
        "CAST(NULL AS BIGINT) AS accepted_answer",
        "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN 0 ELSE id - id % 10 END AS parent_id",
        "CAST(id AS INT) AS score", "CASE WHEN id % 10 = 0 THEN 'Java' END AS tags").repartition(16)


def test_hot_join_key_is_split_without_skew_settings(spark):
    """No reduce task of the join gets much more than its share, and the rows are those of a plain join."""
    df = _hot_postings(spark, 30_000, False).persist()

    def sizes(frame):
        out = frame.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        return sorted(r["count"] for r in out)

    def plain():
        q = P.questions(df).selectExpr(*[f"{c} AS q_{c}" for c in P.POSTING_COLUMNS])
        a = P.answers(df).selectExpr(*[f"{c} AS a_{c}" for c in P.POSTING_COLUMNS])
        return q.join(a, F.col("q_id") == F.col("a_parent_id")).selectExpr("q_id AS qid", *q.columns, *a.columns)

    def run():
        hot, light = P.question_answer_pairs(df, heavy_rows=300), plain()
        assert hot.exceptAll(light).isEmpty() and light.exceptAll(hot).isEmpty()
        return sizes(hot), sizes(light)

    split, together = _no_adaptive_help(spark, run)
    assert together[-1] > 9_000                      # the hot id in one task
    assert sum(split) == sum(together) and split[-1] < 3_000
    df.unpersist()


def test_copies_on_both_sides_multiply_as_in_a_plain_join(spark):
    rows = [(1, 0, None, None, 1, "Java")] * 70 + [(1, 0, None, None, 2, "Java")] * 3 + [(1, 5, None, None, 1, None)] * 2
    rows += [(2, 9, None, 0, 4, None)] * 90 + [(2, 10 + i, None, 0, i, None) for i in range(40)] + [(2, 8, None, 5, 4, None)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    counts = Counter(tuple(r) for r in P.question_answer_pairs(df, heavy_rows=10).collect())
    plain = Counter(tuple(r) for r in P.question_answer_pairs(df, heavy_rows=10 ** 9).collect())
    assert counts == plain and sum(plain.values()) == 73 * 130 + 6


def test_best_score_with_a_third_of_the_distinct_questions_under_one_id(spark):
    df = _hot_postings(spark, 30_000, True).persist()

    def run():
        out = P.scored_postings(df, heavy_rows=100)
        tasks = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        return sorted(map(tuple, out.collect()), key=repr), sorted(r["count"] for r in tasks)

    got, sizes = _no_adaptive_help(spark, run)
    assert got == sorted(map(tuple, P.scored_postings(df, heavy_rows=10 ** 9).collect()), key=repr)
    assert sum(r[1] == 0 for r in got) == 1000       # all have that id's best answer
    assert len({r[6] for r in got if r[1] == 0}) == 1
    assert sizes[-1] < 500                           # of 1,000 under one id and 2,000 others
    df.unpersist()


def test_heavy_ids_are_few_whatever_the_input(spark):
    df = spark.range(200_000).selectExpr("2 AS posting_type", "id", "NULL AS accepted_answer",
                                         "IF(id % 4 = 0, 1L, id % 50000) AS parent_id", "1 AS score", "NULL AS tags")
    found = {r["heavy_id"]: r["n"] for r in P.heavy_ids(df, 10_000).collect()}
    assert list(found) == [1] and 50_000 <= found[1] < 60_000
    assert P.heavy_ids(df, 1).count() <= P.HEAVY_KEYS
    assert P.heavy_ids(df.limit(0), 1).count() == 0


def test_term_in_every_article(spark):
    texts = [("%d" % i, "the " + ("x " * (i % 5)) + ("Java" if i % 3 == 0 else "")) for i in range(3000)]
    arts = spark.createDataFrame(texts, "title string, text string").repartition(5)
    got = {r["term"]: r["n"] for r in ranking.rank_terms(arts, ["the", "Java", "none"]).collect()}
    assert got == {"the": 3000, "Java": 1000, "none": 0}


def test_hot_stratum_sample_and_report(spark):
    rows = [(i, 0, i % 1000) for i in range(20_000)]                       # hot stratum x = 0
    rows += [(100_000 + i, LANG_SPREAD, i % 50) for i in range(30)]
    v = spark.createDataFrame(rows, "id long, x int, y int").repartition(9)
    picks = sorted(tuple(r) for r in stratum_picks(v, 3).collect())
    assert len(picks) == 6 and picks == sorted(tuple(r) for r in stratum_picks(v.repartition(2), 3).collect())
    means = initial_means(v, 6, ["a", "b"], LANG_SPREAD)
    res = cluster_results(weighted_points(v), means, ["a", "b"], LANG_SPREAD).collect()
    assert sum(r["size"] for r in res) == len(rows)
