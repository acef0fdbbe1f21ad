"""Physical-plan properties the operators rely on at scale."""

import re

import __spark_entry__ as E
from tessera.operators import kmeans as K
from tessera.operators import postings as P
from tessera.session import materialize, release
from tessera.sources.postings import parse_posting_lines
from tessera.sources.text import read_lines

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_ranking_reads_only_text_and_combines_map_side(spark):
    p = plan(E.q_rank_terms_combined(spark, SF))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert scans == ["struct<text:string>"]
    assert "partial_count" in p
    exchanges = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", p)
    assert exchanges and all("text" not in cols for cols in exchanges)


def test_per_term_ranking_is_one_scan(spark):
    p = plan(E.q_rank_terms(spark, SF))
    assert len(re.findall(r"\(\d+\) Scan parquet", p)) == 1


def test_stratified_sample_limits_before_shuffle(spark):
    p = plan(E.q_sample_stratified(spark, SF))
    assert re.search(r"WindowGroupLimit.*Partial", p.replace("\n", " ")), p


def test_best_score_aggregates_before_questions_and_answers_meet(spark):
    p = plan(E.q_scored_postings(spark, SF))
    # the only join is that with the few heavy ids
    assert "partial_max" in p and "SortMergeJoin" not in p and set(re.findall(r"\w+Join\w*", p)) == {"BroadcastHashJoin"}


def test_scored_postings_read_a_text_file_once(spark, tmp_path):
    (tmp_path / "p.csv").write_text("1,1,,,5,Java\n2,2,,1,7,\n")
    posts = parse_posting_lines(read_lines(spark, str(tmp_path)))
    scored = P.scored_postings(posts)
    assert [tuple(r) for r in scored.collect()] == [(1, 1, None, None, 5, "Java", 7)]
    assert _text_scans(spark, lambda: P.scored_postings(posts)) == 1


def _text_scans(spark, make) -> int:
    """Scans that run, exchanges that are shared taken once (shown without adaptive planning)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(make())
        return len(re.findall(r"^\(\d+\) Scan text", p, re.M))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_grouped_postings_read_a_text_file_once(spark, tmp_path):
    (tmp_path / "p.csv").write_text("1,1,,,5,Java\n2,2,,1,7,\n2,3,,1,8,\n")
    posts = parse_posting_lines(read_lines(spark, str(tmp_path)))
    assert [(r["qid"], len(r["pairs"])) for r in P.grouped_postings(posts).collect()] == [(1, 2)]
    assert _text_scans(spark, lambda: P.grouped_postings(posts)) == 1


def test_kmeans_step_has_no_exchange_on_compact_points(spark):
    pts = K.compact(K.weighted_points(E._vectors(spark, SF)), 2).persist()
    try:
        step = plan(K.cluster_sums(pts, [(0, 0), (50000, 0)])).split("InMemoryRelation")[0]
        # the only exchange is that of the k partial sums
        assert len(re.findall(r"\(\d+\) Exchange", step)) <= 1
    finally:
        pts.unpersist()


def test_type_filters_prune_union_branches(spark):
    p = plan(E.q_questions(spark, SF))
    assert "lineitem" not in p and "orders" in p


def test_article_job_computes_each_strategy(spark):
    from tessera.plans.article_ranking import rank_articles
    from tessera.sources import testdata as td
    r = rank_articles(td.articles(spark, SF), td.DOCUMENT_TERMS)
    for df in (r.per_term, r.from_index, r.combined):
        assert len(re.findall(r"\(\d+\) Scan parquet", plan(df))) == 1
    assert "title" in plan(r.from_index) or plan(r.from_index) != plan(r.combined)


def test_materialize_cuts_lineage_and_release_removes_table(spark):
    import os
    df = E.q_scored_postings(spark, SF)
    m = materialize(df)
    path = m._tessera_table
    local = path.replace("file:", "")
    assert os.path.isdir(local)
    p = plan(m)
    assert "Window" not in p and m.count() == df.count()
    release(m)
    assert not os.path.exists(local)
