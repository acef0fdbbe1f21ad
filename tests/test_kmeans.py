import pytest
from pyspark.sql import functions as F

from tessera.fixed import LANG_SPREAD
from tessera.functions import nearest_centre, report_line, squared_distance
from tessera.operators import kmeans as K
from tessera.operators import report, sampling


def points(spark, xy, weights=None):
    rows = [(x, y, (weights[i] if weights else 1)) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(rows, "x int, y int, n long")


def test_squared_distance(spark):
    df = spark.createDataFrame([(7, -1, 2, 11)], "a int, b int, c int, d int")
    assert df.select(squared_distance("a", "b", "c", "d").alias("s")).first()["s"] == 169.0
    assert K.point_distance((7, -1), (2, 11)) == 169.0


def test_squared_distance_does_not_wrap(spark):
    df = spark.createDataFrame([(2147483647, 0, -2147483648, 0)], "a int, b int, c int, d int")
    got = df.select(squared_distance("a", "b", "c", "d").alias("s")).first()["s"]
    assert got == float(2 ** 32 - 1) ** 2


@pytest.mark.parametrize("method", ["transform", "least", "cells"])
def test_nearest_centre(spark, method):
    df = points(spark, [(40, -3)])
    c = [(11, 20), (38, -9), (-5, 0), (700, 90)]
    assert df.select(nearest_centre("x", "y", c, method).alias("c")).first()["c"] == 1


@pytest.mark.parametrize("method", ["transform", "least", "cells"])
def test_distance_cap(spark, method):
    df = points(spark, [(46340, 0), (46341, 0), (53000, 0), (60000, 0)])
    c = [(0, 0), (100000, 0)]
    got = [r["c"] for r in df.select(nearest_centre("x", "y", c, method).alias("c")).collect()]
    assert got == [0, 0, 0, 1]


def test_equal_centres_lowest_index_other_keeps_mean(spark):
    df = points(spark, [(1, 1), (3, 3)])
    centres = [(5, 5), (5, 5), (9, 9)]
    assert [r["cluster"] for r in K.assign_clusters(df, centres).collect()] == [0, 0]
    assert K.kmeans_step(df, centres) == [(2, 2), (5, 5), (9, 9)]


def test_average_truncates(spark):
    df = points(spark, [(5, 2), (6, 4), (9, 20)])
    assert K.kmeans_step(df, [(0, 0)]) == [(6, 8)]
    neg = points(spark, [(-7, 0), (0, 0)])
    assert K.kmeans_step(neg, [(0, 0)]) == [(-3, 0)]


def test_weights_equal_repeats(spark):
    a = points(spark, [(1, 1), (1, 1), (1, 1), (10, 4)])
    b = points(spark, [(1, 1), (10, 4)], weights=[3, 1])
    assert K.kmeans_step(a, [(0, 0)]) == K.kmeans_step(b, [(0, 0)]) == [(3, 1)]


def test_kmeans_converges_and_is_stable(spark):
    xy = [(0, 1), (0, 3), (0, 100), (0, 104), (50000, 10), (50000, 12)]
    vectors = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "id long, x int, y int")
    res = K.kmeans(vectors, [(0, 0), (0, 50), (50000, 0)], eta=20.0, max_iter=120)
    assert res.converged
    assert res.means == [(0, 2), (0, 102), (50000, 11)]
    assert res.shifts[-1] < 20.0
    # a step from the converged state changes nothing
    pts = K.weighted_points(vectors)
    assert K.kmeans_step(pts, res.means) == res.means


def test_kmeans_stops_at_max_iter(spark):
    vectors = spark.createDataFrame([(0, 0, 0), (1, 0, 1000)], "id long, x int, y int")
    res = K.kmeans(vectors, [(0, 500), (0, 501)], eta=0.0, max_iter=1)
    assert res.iterations == 1 and not res.converged
    assert len(res.trace) == 2


def test_total_shift_frame(spark):
    old = spark.createDataFrame([(0, 7, -1), (1, 0, 0)], "cluster int, x int, y int")
    new = spark.createDataFrame([(0, 2, 11), (1, 0, 0)], "cluster int, x int, y int")
    assert K.total_shift_frame(old, new).first()["total_shift"] == 169.0
    assert K.total_shift([(7, -1), (0, 0)], [(2, 11), (0, 0)]) == 169.0
    assert K.converged(19.9) and not K.converged(20.0)
    assert K.total_shift_frame(old.limit(0), new.limit(0)).first()["total_shift"] == 0.0


@pytest.mark.parametrize("rows", [[(0, 1, 1)], [(0, 1, 1), (1, 0, 0), (2, 5, 5)], [(7, 1, 1), (8, 0, 0)], []])
def test_total_shift_frame_of_unequal_sets_fails(spark, rows):
    old = spark.createDataFrame([(0, 7, -1), (1, 0, 0)], "cluster int, x int, y int")
    new = spark.createDataFrame(rows, "cluster int, x int, y int")
    with pytest.raises(Exception, match="one side only"):
        K.total_shift_frame(old, new).collect()


def test_step_tasks_follow_rows_times_centres(spark):
    assert K.step_tasks(10, 3) == 1
    assert K.step_tasks(100_000, 45) == 9
    assert K.step_tasks(0, 45) == 1
    pts = points(spark, [(i, i % 7) for i in range(1000)])
    assert K.compact(pts, 2000).rdd.getNumPartitions() == 4


def test_report_median_mode_percent(spark):
    # cluster 0: scores 1, 2 -> median 1; cluster 1: scores -4, 1 -> median -1
    xy = [(0, 1), (0, 2), (LANG_SPREAD, -4), (LANG_SPREAD, 1)]
    pts = points(spark, xy)
    res = report.cluster_results(pts, [(0, 0), (LANG_SPREAD, 0)], ["A", "B"], LANG_SPREAD)
    got = [(r["cluster"], r["label"], r["percent"], r["size"], r["median_score"]) for r in res.collect()]
    assert got == [(1, "B", 100.0, 2, -1), (0, "A", 100.0, 2, 1)]


def test_report_modal_ties_and_sizes(spark):
    xy = [(0, 5), (LANG_SPREAD, 6), (LANG_SPREAD, 7), (0, 9)]
    pts = points(spark, xy, weights=[2, 1, 1, 1])
    res = report.cluster_results(pts, [(25000, 0)], ["A", "B"], LANG_SPREAD).collect()
    # scores 5, 5, 6, 7, 9 -> middle 6; term A has 3 of 5
    assert [(r["label"], r["size"], r["median_score"]) for r in res] == [("A", 5, 6)]
    assert res[0]["percent"] == 60.0


def test_report_modal_tie_goes_to_lower_index(spark):
    pts = points(spark, [(LANG_SPREAD, 1), (0, 2)])
    res = report.cluster_results(pts, [(25000, 0)], ["A", "B"], LANG_SPREAD).collect()
    assert [(r["label"], r["percent"], r["median_score"]) for r in res] == [("A", 50.0, 1)]


def test_report_unknown_term_fails(spark):
    pts = points(spark, [(-LANG_SPREAD, 1)])
    with pytest.raises(Exception):
        report.cluster_results(pts, [(0, 0)], ["A"], LANG_SPREAD).collect()


def test_report_line_format(spark):
    df = spark.createDataFrame([(5, "Java", 66.25, 12)], "median_score int, label string, percent double, size long")
    assert df.select(report_line().alias("l")).first()["l"] == \
        "      5  Java              (66.3 %)           12"


def vectors_for_sampling(spark, strata=3, per=20):
    rows = [(s * 100 + i, s * LANG_SPREAD, i) for s in range(strata) for i in range(per)]
    return spark.createDataFrame(rows, "id long, x int, y int")


def test_stratified_sample_contract(spark):
    v = vectors_for_sampling(spark)
    a = sampling.initial_means(v, 6, ["A", "B", "C"], LANG_SPREAD)
    b = sampling.initial_means(v.repartition(5), 6, ["A", "B", "C"], LANG_SPREAD)
    assert a == b and len(a) == 6
    assert [x for x, _ in a] == [0, 0, LANG_SPREAD, LANG_SPREAD, 2 * LANG_SPREAD, 2 * LANG_SPREAD]


def test_sample_k_not_divisible(spark):
    with pytest.raises(ValueError):
        sampling.initial_means(vectors_for_sampling(spark), 7, ["A", "B", "C"], LANG_SPREAD)


def test_sample_stratum_too_small(spark):
    with pytest.raises(ValueError):
        sampling.initial_means(vectors_for_sampling(spark, per=2), 9, ["A", "B", "C"], LANG_SPREAD)


def test_sample_extra_stratum_fails(spark):
    v = vectors_for_sampling(spark).union(
        spark.createDataFrame([(999, -LANG_SPREAD, 1)] * 3, "id long, x int, y int"))
    with pytest.raises(ValueError):
        sampling.initial_means(v, 6, ["A", "B", "C"], LANG_SPREAD)


def test_global_sample_small_spread(spark):
    v = spark.createDataFrame([(i, (i % 3) * 100, i) for i in range(50)], "id long, x int, y int")
    a = sampling.initial_means(v, 5, ["A", "B", "C"], spread=100)
    assert len(a) == 5 and len(set(a)) == 5
    assert a == sampling.initial_means(v.repartition(7), 5, ["A", "B", "C"], spread=100)


def test_cluster_sizes_sum_to_points(spark):
    v = vectors_for_sampling(spark)
    pts = K.weighted_points(v)
    res = report.cluster_results(pts, [(0, 0), (LANG_SPREAD, 0), (2 * LANG_SPREAD, 0)],
                                 ["A", "B", "C"], LANG_SPREAD)
    assert res.agg(F.sum("size")).first()[0] == v.count()


def test_average_vectors(spark):
    v = spark.createDataFrame([(5, 2), (6, 4), (9, 20)], "x int, y int")
    assert tuple(K.average_vectors(v).first()) == (6, 8)
    neg = spark.createDataFrame([(-7, 0), (0, 0)], "x int, y int")
    assert tuple(K.average_vectors(neg).first()) == (-3, 0)
    w = spark.createDataFrame([(1, 1, 3), (10, 4, 1)], "x int, y int, n long")
    assert tuple(K.average_vectors(w, "n").first()) == (3, 1)


def test_salts_do_not_change_the_sample(spark):
    from tessera.operators.sampling import stratum_picks
    rows = [(i, (i % 2) * LANG_SPREAD, i % 97) for i in range(3000)]
    v = spark.createDataFrame(rows, "id long, x int, y int")
    picks = [sorted(tuple(r) for r in stratum_picks(v, 40, salts=n).collect()) for n in (1, 7, None)]
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 80


def test_sample_vectors_frame_matches_initial_means(spark):
    v = vectors_for_sampling(spark)
    frame = [(r["x"], r["y"]) for r in
             sampling.sample_vectors(v, 6, ["A", "B", "C"], LANG_SPREAD).orderBy("cluster").collect()]
    assert frame == sampling.initial_means(v, 6, ["A", "B", "C"], LANG_SPREAD)
    small = [(r["x"], r["y"]) for r in
             sampling.sample_vectors(v, 5, ["A", "B", "C"], spread=100).orderBy("cluster").collect()]
    assert small == sampling.initial_means(v, 5, ["A", "B", "C"], spread=100)


def test_cells_give_the_same_centres(spark):
    import random

    from tessera.functions.geometry import CELL, nearest_centre
    rnd = random.Random(8)
    assert (CELL - 1) ** 2 < 2147483647 <= CELL ** 2
    centres = [(rnd.choice([-50000, 0, 50000, 100000, CELL, -CELL, 7 * CELL - 1, rnd.randrange(-10 ** 6, 10 ** 6)]), rnd.randrange(-300, 300))
               for _ in range(300)] + [(0, 0), (0, 0), (-2 ** 31, 5), (2 ** 31 - 1, 5)]
    points = [(rnd.choice([c[0] for c in centres]) + rnd.choice([0, 0, 1, -1, CELL - 1, CELL, CELL + 1, -CELL, 1 - CELL, rnd.randrange(-10 ** 5, 10 ** 5)]),
               rnd.randrange(-400, 400)) for _ in range(3000)] + [(46340, 0), (46341, 0), (-46341, 0)]
    points = [(x, y) for x, y in points if -2 ** 31 <= x < 2 ** 31]
    df = spark.createDataFrame(points, "x int, y int")
    for some in (centres, centres[:3], centres[:1]):
        rows = df.select(nearest_centre("x", "y", some, "cells").alias("c"), nearest_centre("x", "y", some, "transform").alias("t"),
                         nearest_centre("x", "y", some).alias("a")).collect()
        assert all(r.c == r.t == r.a for r in rows)

