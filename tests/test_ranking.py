import pytest

from tessera.fixed import LANGS
from tessera.operators import ranking
from tessera.plans.article_ranking import rank_articles

# own articles: terms at the start, in the middle and at the end of a text, repeated,
# glued to marks, in another case, in an empty text and in a missing one
TERMS = ["Perl", "CSS", "Ruby", "PHP"]
SHELF = [
    ("a", "PHP"),
    ("b", "CSS before PHP, after PHP"),
    ("c", "ruby (Ruby) Ruby Ruby"),
    ("d", "PHP  CSS"),
    ("e", ""),
    ("f", "CSS\tPHP"),
    ("g", "x Ruby"),
    ("h", "CSS y CSS PHP"),
    ("i", None),
]
COUNTS = {"PHP": 4, "CSS": 3, "Ruby": 2, "Perl": 0}


def pairs(df):
    return [(r["term"], r["n"]) for r in df.orderBy("rank").collect()]


@pytest.mark.parametrize("term", TERMS)
def test_occurrences_of_each_term(articles, term):
    assert ranking.occurrences_of_term(articles(SHELF), term) == COUNTS[term]


def test_rankings_of_the_shelf(articles):
    df = articles(SHELF)
    ranked = sorted(COUNTS.items(), key=lambda c: -c[1])
    assert pairs(ranking.rank_terms(df, TERMS)) == ranked
    assert pairs(ranking.rank_terms_combined(df, TERMS)) == ranked[:3]
    assert pairs(ranking.rank_terms_from_index(ranking.inverted_index(df, TERMS), TERMS)) == ranked[:3]


def test_index_rows(articles):
    idx = ranking.inverted_index(articles(SHELF), TERMS)
    assert ranking.index_term_count(idx) == 3
    assert sorted((r["term"], r["title"]) for r in idx.collect()) == [
        ("CSS", "b"), ("CSS", "d"), ("CSS", "h"), ("PHP", "a"), ("PHP", "b"), ("PHP", "d"), ("PHP", "h"), ("Ruby", "c"), ("Ruby", "g")]


def test_mention_is_exact_token(articles):
    df = articles([("a", "coffee from Java, strong"), ("b", "java"), ("c", "Java\nJava")])
    assert ranking.occurrences_of_term(df, "Java") == 0


def test_article_counts_once(articles):
    df = articles([("a", "Java Java Java"), ("b", "x Java")])
    assert pairs(ranking.rank_terms_combined(df, ["Java"])) == [("Java", 2)]


def test_absent_term_zero_only_in_per_term_ranking(articles):
    df = articles(SHELF)
    assert dict(pairs(ranking.rank_terms(df, TERMS)))["Perl"] == 0
    assert "Perl" not in dict(pairs(ranking.rank_terms_combined(df, TERMS)))
    idx = ranking.inverted_index(df, TERMS)
    assert "Perl" not in dict(pairs(ranking.rank_terms_from_index(idx, TERMS)))


def test_ties_follow_term_order(articles):
    df = articles([("1", "B A"), ("2", "C")])
    assert pairs(ranking.rank_terms(df, ["C", "A", "B"])) == [("C", 1), ("A", 1), ("B", 1)]


@pytest.mark.parametrize("bad", [["Java", "Java"], ["Java", ""], []])
def test_bad_term_lists_rejected(articles, bad):
    with pytest.raises(ValueError):
        ranking.rank_terms(articles(SHELF), bad)


def test_three_strategies_agree(articles):
    r = rank_articles(articles(SHELF), LANGS)
    per_term = [p for p in pairs(r.per_term) if p[1] > 0]
    assert per_term == pairs(r.from_index) == pairs(r.combined)
    assert len(pairs(r.per_term)) == len(LANGS)


def test_term_occurrences_frame(articles):
    row = ranking.term_occurrences(articles(SHELF), "PHP").collect()
    assert [(r["term"], r["n"]) for r in row] == [("PHP", 4)]


def test_write_inverted_index_partitioned_by_term(spark, articles):
    import os
    import tempfile
    idx = ranking.inverted_index(articles(SHELF), ["Ruby", "CSS", "Perl"])
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-index-"), "index")
    ranking.write_inverted_index(idx, out, files_per_term=None)
    assert sorted(d for d in os.listdir(out) if d.startswith("term=")) == ["term=CSS", "term=Ruby"]
    back = spark.read.parquet(out)
    css = back.where("term = 'CSS'")
    assert "PartitionFilters: [isnotnull(term" in css._sc._jvm.PythonSQLUtils.explainString(
        css._jdf.queryExecution(), "formatted")
    assert sorted(r["title"] for r in css.collect()) == ["b", "d", "h"]
    assert pairs(ranking.rank_terms_from_index(back, ["Ruby", "CSS"])) == [("CSS", 3), ("Ruby", 2)]


def test_long_term_lists_use_a_join_with_the_same_result(spark, articles):
    df = articles(SHELF)
    many = ["CSS", "PHP", "Ruby"] + [f"t{i}" for i in range(ranking.INLINE_TERMS_MAX)]
    got = pairs(ranking.rank_terms(df, many))
    assert got[:3] == [("PHP", 4), ("CSS", 3), ("Ruby", 2)]
    assert all(n == 0 for _, n in got[3:]) and len(got) == len(many)
    rows = lambda idx: sorted((r["term"], r["title"]) for r in idx.collect())
    assert rows(ranking.inverted_index(df, many)) == rows(ranking.inverted_index(df, many[:3]))
    few = pairs(ranking.rank_terms(df, many[:3]))
    assert got[:3] == few
    assert pairs(ranking.rank_terms_combined(df, many)) == few


def test_write_inverted_index_bounded_files(spark, articles):
    import os
    import tempfile
    rows = [(str(i), "Java and Scala" if i % 2 else "Java") for i in range(400)]
    idx = ranking.inverted_index(articles(rows).repartition(16), ["Scala", "Java"])
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-index-"), "index")
    ranking.write_inverted_index(idx, out, files_per_term=3)
    for term, n in (("Java", 400), ("Scala", 200)):
        files = [f for f in os.listdir(os.path.join(out, f"term={term}")) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 3
        assert spark.read.parquet(out).where(f"term = '{term}'").count() == n
