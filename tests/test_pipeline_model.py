"""The whole clustering job against a plain-Python model, on random postings."""

import hashlib
import random

import pytest

from tessera.plans.posting_clusters import cluster_postings
from tests.test_kmeans_model import model_kmeans, model_report

SCHEMA = ("posting_type int, id long, accepted_answer long, parent_id long, "
          "score int, tags string")


def model_job(rows, terms, spread, k, seed=42, eta=20.0, max_iter=120):
    questions = {r for r in rows if r[0] == 1}                       # distinct full rows
    best = {}
    for r in rows:
        if r[0] == 2 and r[3] is not None:
            best[r[3]] = max(best.get(r[3], r[4]), r[4])
    vectors = []
    for q in questions:
        if q[1] in best:
            idx = 0 if q[5] is None else (terms.index(q[5]) if q[5] in terms else -1)
            vectors.append((q[1], idx * spread, best[q[1]]))
    per = k // len(terms)
    strata = {}
    for v in vectors:
        strata.setdefault(v[1], []).append(v)
    centres = []
    for x in sorted(strata):
        ranked = sorted(strata[x], key=lambda v: (hashlib.md5(f"{seed}:{v[0]}".encode()).hexdigest(),
                                                  v[0], v[1], v[2]))
        centres += [(v[1], v[2]) for v in ranked[:per]]
    xy = [(v[1], v[2]) for v in vectors]
    means, iters = model_kmeans(xy, centres, eta, max_iter)
    return centres, means, iters, model_report(xy, means, spread, terms)


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_job_matches_model(spark, seed):
    rnd = random.Random(seed)
    terms = ["a", "b", "c"]
    rows = []
    for q in range(1, 80):
        tag = rnd.choice(terms + [None])
        rows.append((1, q, None, None, rnd.randint(0, 5), tag))
        if rnd.random() < 0.1:
            rows.append((1, q, None, None, rows[-1][4], tag))         # identical copy
    for a in range(400):
        rows.append((2, 1000 + a, None, rnd.choice([None, *range(1, 85)]), rnd.randint(-20, 400), None))
    df = spark.createDataFrame(rows, SCHEMA)
    job = cluster_postings(df, terms, spread=1000, k=6)
    centres, means, iters, report = model_job(rows, terms, 1000, 6)
    assert job.initial == centres
    assert job.means == means and job.kmeans.iterations == iters
    got = {r["cluster"]: (r["label"], r["percent"], r["size"], r["median_score"])
           for r in job.results(spark).collect()}
    assert got == report
