"""k-means and the cluster report against a plain-Python model of the rules."""

import random

import pytest

from tessera.operators import kmeans as K
from tessera.operators import report

CAP = 2147483647.0


def sq(a, b):
    return float(a[0] - b[0]) ** 2 + float(a[1] - b[1]) ** 2


def closest(p, centres):
    best, idx = CAP, 0
    for i, c in enumerate(centres):
        d = sq(p, c)
        if d < best:
            best, idx = d, i
    return idx


def tdiv(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def model_kmeans(vectors, means, eta, max_iter):
    it = 1
    while True:
        groups = {}
        for v in vectors:
            groups.setdefault(closest(v, means), []).append(v)
        new = list(means)
        for i, vs in groups.items():
            new[i] = (tdiv(sum(v[0] for v in vs), len(vs)), tdiv(sum(v[1] for v in vs), len(vs)))
        dist = sum(sq(a, b) for a, b in zip(means, new))
        if dist < eta or it >= max_iter:
            return new, it
        means, it = new, it + 1


def model_report(vectors, means, spread, terms):
    groups = {}
    for v in vectors:
        groups.setdefault(closest(v, means), []).append(v)
    out = {}
    for c, vs in groups.items():
        counts = {}
        for v in vs:
            counts[tdiv(v[0], spread)] = counts.get(tdiv(v[0], spread), 0) + 1
        top = max(counts.items(), key=lambda kv: (kv[1], -kv[0]))[0]
        ys = sorted(v[1] for v in vs)
        n = len(ys)
        med = ys[n // 2] if n % 2 else tdiv(ys[n // 2 - 1] + ys[n // 2], 2)
        out[c] = (terms[top], counts[top] / n * 100, n, med)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_kmeans_and_report_match_model(spark, seed):
    rnd = random.Random(seed)
    spread = rnd.choice([50000, 20000, 1000])
    terms = ["a", "b", "c", "d"]
    vectors = [(rnd.randrange(len(terms)) * spread, rnd.randint(-300, 3000)) for _ in range(300)]
    k = rnd.randint(2, 9)
    init = [(rnd.randrange(len(terms)) * spread, rnd.randint(-100, 5000)) for _ in range(k)]
    eta, max_iter = rnd.choice([(20.0, 120), (0.0, 7), (1e12, 3)])
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(vectors)], "id long, x int, y int")
    res = K.kmeans(df, init, eta, max_iter)
    means, iters = model_kmeans(vectors, init, eta, max_iter)
    assert res.means == means and res.iterations == iters
    got = {r["cluster"]: (r["label"], r["percent"], r["size"], r["median_score"])
           for r in report.cluster_results(K.weighted_points(df), res.means, terms, spread).collect()}
    assert got == model_report(vectors, res.means, spread, terms)
