"""End-to-end jobs with the original default parameters (15 terms, k = 45)."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.fixed import KMEANS_KERNELS, LANG_SPREAD, LANGS, REPORT_HEADER
from tessera.plans.article_ranking import rank_article_file
from tessera.plans.posting_clusters import (
    cluster_posting_file, cluster_postings, print_report, vectors_from_postings, write_report,
)
from tessera.sources import parse_posting_lines
from tessera.sources import testdata as td


def _posting_lines(seed=5, per_lang=6):
    rnd = random.Random(seed)
    lines, qid, aid = [], 1, 100000
    for li, lang in enumerate(LANGS):
        for _ in range(per_lang):
            lines.append(f"1,{qid},,,{rnd.randint(0, 9)},{lang}")
            for _ in range(rnd.randint(1, 3)):
                lines.append(f"2,{aid},,{qid},{rnd.randint(0, 50) * (li + 1)},")
                aid += 1
            qid += 1
    lines.append(f"1,{qid},,,3")                 # no tag -> first language
    lines.append(f"2,{aid},,{qid},11,")
    lines.append(f"1,{qid + 1},,,3,Java")         # unanswered -> dropped
    return lines


def _write(lines) -> str:
    folder = tempfile.mkdtemp(prefix="tessera-e2e-")
    with open(os.path.join(folder, "postings.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return folder


@pytest.fixture(scope="module")
def job(spark):
    return cluster_posting_file(spark, _write(_posting_lines()))


def test_default_job_shape(spark, job):
    assert len(job.initial) == KMEANS_KERNELS and len(job.means) == KMEANS_KERNELS
    rows = job.results(spark).collect()
    assert 0 < len(rows) <= KMEANS_KERNELS
    assert all(r["label"] in LANGS and r["size"] > 0 for r in rows)
    assert sum(r["size"] for r in rows) == job.n_vectors == 15 * 6 + 1
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    meds = [(r["median_score"], r["cluster"]) for r in rows]
    assert meds == sorted(meds)
    assert job.kmeans.converged or job.kmeans.iterations == 120


def test_untagged_question_counts_as_first_language(spark):
    posts = parse_posting_lines(spark.createDataFrame([(ln,) for ln in _posting_lines()], "value string"))
    xs = {r["x"] for r in vectors_from_postings(posts).collect()}
    assert xs == {i * LANG_SPREAD for i in range(len(LANGS))}


def test_report_text(spark, job, capsys):
    print_report(job, spark)
    out = capsys.readouterr().out.splitlines()
    assert tuple(out[:3]) == REPORT_HEADER
    assert len(out) == 3 + job.results(spark).count()
    folder = os.path.join(tempfile.mkdtemp(prefix="tessera-report-"), "out")
    write_report(job, spark, folder)
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    text = "".join(open(os.path.join(folder, f), encoding="utf-8").read() for f in files)
    assert text.splitlines() == out[3:]


def test_job_leaves_nothing_cached(spark, job):
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    again = cluster_posting_file(spark, _write(_posting_lines()))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
    assert again.means == job.means and again.rows == job.rows


def test_trace_frame(spark, job):
    tr = job.trace(spark)
    assert tr.count() == KMEANS_KERNELS * job.kmeans.iterations
    last = tr.where(F.col("iter") == job.kmeans.iterations).orderBy("cluster").collect()
    assert [(r["new_x"], r["new_y"]) for r in last] == job.means


def test_unknown_tag_fails_sampling_unless_dropped(spark):
    lines = _posting_lines() + ["1,9999,,,1,Cobol", "2,99999,,9999,5,"]
    df = spark.createDataFrame([(ln,) for ln in lines], "value string")
    posts = parse_posting_lines(df)
    with pytest.raises(ValueError):
        cluster_postings(posts)                  # a 16th stratum: 48 centres, not 45
    j = cluster_postings(posts, unknown="drop")
    assert j.n_vectors == 15 * 6 + 1


def test_article_file_rankings(spark):
    folder = tempfile.mkdtemp(prefix="tessera-dump-")
    arts = [("a", "PHP"), ("b", "CSS before PHP, after PHP"), ("c", "ruby (Ruby) Ruby Ruby"), ("d", "PHP  CSS"), ("e", ""),
            ("g", "x Ruby"), ("h", "CSS y CSS PHP")]
    with open(os.path.join(folder, "dump.txt"), "w", encoding="utf-8") as f:
        for t, x in arts:
            f.write(td.ARTICLE_PREFIX + t + "</title><text>" + x + td.ARTICLE_SUFFIX + "\n")
    r = rank_article_file(spark, folder)
    per_term = [(x["term"], x["n"]) for x in r.per_term.collect()]
    assert per_term[:4] == [("PHP", 4), ("CSS", 3), ("Ruby", 2), ("JavaScript", 0)]
    assert len(per_term) == len(LANGS)
    assert [(x["term"], x["n"]) for x in r.combined.collect()] == per_term[:3]
    assert [(x["term"], x["n"]) for x in r.from_index.collect()] == per_term[:3]


def test_command_lines(spark, capsys):
    from tessera.plans import article_ranking, posting_clusters
    folder = _write(_posting_lines())
    posting_clusters.main([folder, "--debug", "--master", "local[2]"])
    out = capsys.readouterr().out
    lines = out.splitlines()
    assert lines[0].split("\t") == ["iter", "cluster", "old_x", "old_y", "new_x", "new_y", "shift"]
    assert lines[1].startswith("1\t0\t") and "limit for the shift 20.0" in out and REPORT_HEADER[0] in out
    dump = tempfile.mkdtemp(prefix="tessera-cli-")
    with open(os.path.join(dump, "d.txt"), "w", encoding="utf-8") as f:
        f.write(td.ARTICLE_PREFIX + "1</title><text>notes on Scala" + td.ARTICLE_SUFFIX + "\n")
    article_ranking.main([dump, "--terms", "Scala,Java"])
    out = capsys.readouterr().out.splitlines()
    assert out[0] == "per-term counts: [('Scala', 1), ('Java', 0)]"
    assert out[2] == "combined count: [('Scala', 1)]"
