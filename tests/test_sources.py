import os
import tempfile

import pytest

from tessera.operators import postings, ranking
from tessera.plans.article_ranking import read_articles
from tessera.plans.posting_clusters import cluster_posting_file, vectors_from_postings
from tessera.sources import parse_article_lines, parse_posting_lines, read_lines
from tessera.sources import testdata as td


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _write(tmp: str, name: str, text: str) -> str:
    path = os.path.join(tmp, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_lines_one_row_per_line(spark):
    tmp = tempfile.mkdtemp(prefix="tessera-lines-")
    _write(tmp, "a.txt", "one\ntwo\n")
    _write(tmp, "b.txt", "three\n")
    got = sorted(r["value"] for r in read_lines(spark, tmp).collect())
    assert got == ["one", "three", "two"]


def test_read_lines_missing_path_fails(spark):
    with pytest.raises(Exception):
        read_lines(spark, "/nonexistent/tessera/none.txt").collect()


def test_article_file_round_trip(spark):
    tmp = tempfile.mkdtemp(prefix="tessera-articles-")
    body = "\n".join(td.ARTICLE_PREFIX + t + "</title><text>" + x + td.ARTICLE_SUFFIX
                     for t, x in [("Scala", "notes on Scala"), ("J", "Java </title><text> x")])
    path = _write(tmp, "dump.txt", body + "\n")
    got = sorted((r["title"], r["text"]) for r in read_articles(spark, path).collect())
    assert got == [("J", "Java </title><text> x"), ("Scala", "notes on Scala")]


def test_article_empty_text_and_title(spark):
    v = td.ARTICLE_PREFIX + "</title><text>" + td.ARTICLE_SUFFIX
    got = parse_article_lines(lines(spark, [v])).collect()
    assert [(r["title"], r["text"]) for r in got] == [("", "")]


@pytest.mark.parametrize("bad", [
    "no marker here at all, just a long enough line of text",
    "short</title><text>",                                  # marker inside the prefix
    td.ARTICLE_PREFIX + "t</title><text>" + "tooshort",      # no room for the suffix
])
def test_article_malformed_fails(spark, bad):
    arts = parse_article_lines(lines(spark, [bad, td.ARTICLE_PREFIX + "t</title><text>x" + td.ARTICLE_SUFFIX]))
    for action in (lambda: arts.collect(), lambda: arts.count(), lambda: arts.select("title").collect(),
                   lambda: ranking.occurrences_of_term(arts, "x")):
        with pytest.raises(Exception, match="malformed article line"):
            action()


@pytest.mark.parametrize("bad", ["1,10,12,,5x,Java", "2,abc,xyz,10,7,", "3,zz,zz,zz,zz", "1,2,,3", "2,5,,1.0,7", "2, 5,,1,7", "2,5,,1,99999999999", ""])
def test_malformed_posting_fails_whatever_is_read(spark, bad, tmp_path):
    good = ["1,10,,,5,Java", "2,11,,10,7,"]
    posts = parse_posting_lines(lines(spark, good + [bad]))
    actions = [lambda: posts.collect(), lambda: posts.count(), lambda: posts.select("tags").collect(),
               lambda: postings.scored_postings(posts).collect(), lambda: postings.questions(posts).count(),
               lambda: postings.answers(posts).select("score").collect(),
               lambda: vectors_from_postings(posts).collect()]
    for action in actions:
        with pytest.raises(Exception, match="field|fewer than 5"):
            action()
    (tmp_path / "postings.csv").write_text("\n".join(good + [bad] + good) + "\n")
    with pytest.raises(Exception, match="field|fewer than 5"):
        cluster_posting_file(spark, str(tmp_path), k=15)


def test_posting_lines(spark):
    got = parse_posting_lines(lines(spark, [
        "1,10,12,,5,Java", "2,12,,10,7,", "1,11,,,0", "2,5,,7,1,", "1,2,,,0,,x",
        "1,3,,,4,C++,extra,fields",
    ])).collect()
    assert [tuple(r) for r in got] == [
        (1, 10, 12, None, 5, "Java"),
        (2, 12, None, 10, 7, None),
        (1, 11, None, None, 0, None),
        (2, 5, None, 7, 1, None),
        (1, 2, None, None, 0, ""),
        (1, 3, None, None, 4, "C++"),
    ]


@pytest.mark.parametrize("bad", ["1,2", "1,2,,,x", "1, 2,,,0", "a,2,,,0", "1,2,,,1.5",
                                 "1,2,,,99999999999", ",,,", "1,2,z,,0"])
def test_posting_malformed_fails(spark, bad):
    with pytest.raises(Exception):
        parse_posting_lines(lines(spark, [bad])).collect()


def test_posting_lines_round_trip(spark):
    rows = [(1, 10, 12, None, 5, "Java"), (2, 12, None, 10, 7, None), (1, 11, None, None, 0, None)]
    df = spark.createDataFrame(rows, "posting_type int, id long, accepted_answer long, "
                                     "parent_id long, score int, tags string")
    back = parse_posting_lines(td.posting_lines(df)).collect()
    assert [tuple(r) for r in back] == rows


@pytest.mark.parametrize("bad", ["1,2", "1,2,,,x", "1,2,,,99999999999", "1, 2,,,0"])
def test_posting_errors_do_not_depend_on_ansi(spark, bad):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            parse_posting_lines(lines(spark, [bad])).collect()
        ok = parse_posting_lines(lines(spark, ["1,2,,,0,x"])).collect()
        assert [tuple(r) for r in ok] == [(1, 2, None, None, 0, "x")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
