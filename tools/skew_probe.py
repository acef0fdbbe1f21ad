"""Skew check for the best-answer-score plan (a measurement, not a query).

Derives a skewed postings input from the test tables — every third line item
is re-pointed at order 0, so one question holds a third of all answers —
disables broadcast joins (as at scale, where the question side is too big to
broadcast), and runs ``scored_postings`` and a join-then-regroup plan through
the noop sink.  Run with an event log and compare the stages:

    D=$(mktemp -d) && TESSERA_EVENT_LOG_DIR=$D python tools/skew_probe.py [sf_dir]
    python tools/stages.py $D/eventlog_v2_*
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import postings as P  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources import testdata as td  # noqa: E402


def main(sf: str) -> None:
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    lineitem = td.load_table(spark, sf, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("bigint"))
        .otherwise(F.col("l_orderkey")))
    posts = td.postings_from_tables(td.load_table(spark, sf, "orders"), lineitem)
    pairs = P.question_answer_pairs(posts)
    qcols = [c for c in pairs.columns if c.startswith("q_")]
    plans = [("warm-up", P.scored_postings(posts)), ("scored_postings", P.scored_postings(posts)),
             ("join-then-regroup", pairs.groupBy(*qcols).agg(F.max("a_score").alias("hs")))]
    for label, df in plans:
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{label}: {time.perf_counter() - t0:.2f}s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
