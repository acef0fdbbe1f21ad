import os
import tempfile

from tessera.sources import testdata as td
from tessera.streaming.ranking import start_ranking


def _dump(folder: str, name: str, articles) -> None:
    tmp = os.path.join(folder, "." + name)
    with open(tmp, "w", encoding="utf-8") as f:
        for title, text in articles:
            f.write(td.ARTICLE_PREFIX + title + "</title><text>" + text + td.ARTICLE_SUFFIX + "\n")
    os.rename(tmp, os.path.join(folder, name))   # appear atomically to the file source


def test_incremental_ranking(spark):
    folder = tempfile.mkdtemp(prefix="tessera-stream-in-")
    _dump(folder, "a.txt", [("1", "notes on Scala"), ("2", "from Java by way of Scala")])
    ckpt = tempfile.mkdtemp(prefix="tessera-stream-ckpt-")
    q = start_ranking(spark, folder, ["Scala", "Java", "Haskell"], query_name="rank_stream_test", sink="memory",
                      checkpoint_location=ckpt)
    try:
        q.processAllAvailable()
        got = {r["term"]: r["n"] for r in spark.table("rank_stream_test").collect()}
        assert got == {"Scala": 2, "Java": 1}
        _dump(folder, "b.txt", [("3", "Java and Haskell"), ("4", "Java Java")])
        q.processAllAvailable()
        rows = spark.table("rank_stream_test").collect()
        assert [(r["term"], r["n"]) for r in rows] == [("Java", 3), ("Scala", 2), ("Haskell", 1)]
    finally:
        q.stop()
    # restarting from the same checkpoint resumes: old files are not recounted
    _dump(folder, "c.txt", [("5", "Scala")])
    q = start_ranking(spark, folder, ["Scala", "Java", "Haskell"], query_name="rank_stream_test2", sink="memory",
                      checkpoint_location=ckpt)
    try:
        q.processAllAvailable()
        rows = spark.table("rank_stream_test2").collect()
        assert [(r["term"], r["n"]) for r in rows] == [("Java", 3), ("Scala", 3), ("Haskell", 1)]
    finally:
        q.stop()
