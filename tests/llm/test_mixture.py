import math
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
from tessera.llm import mixture
from tests.oracle import compare, duck_connection

SF = "/root/testdata/sf0.001"
ROWS = [(i, f"w{i} " * (i % 7 + 1), ["a", "b", "é", None][i % 4] if i < 60 else "hot") for i in range(200)]
ROWS += [(500, None, "a"), (501, "", "b"), (502, " \t\n", None), (7, "dup dup", "a"), (7, "dup dup", "a"), (None, "no id", "b")]
ROWS += [(600 + i, "", "empty source") for i in range(3)] + [(700, "x " * 20000, "one long")]


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """source -> target: share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free = dict.fromkeys(order, 0.0), set(order)
    left = float(sum(sizes.values()))
    while free:
        share = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * share > cap * sizes[s]}
        if not over:
            target.update({s: w[s] * share for s in free})
            break
        for s in over:
            target[s] = float(cap * sizes[s])
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(*r, "x", 0) for r in ROWS], "doc_id long, text string, source string, turn string, size int")


def test_targets_and_taken(docs):
    rows = mixture.plan(docs).collect()
    assert len(rows) == len(ROWS)
    count = lambda t: len(re.findall(r"[^ \t\n\x0b\f\r]+", t or ""))
    sizes = Counter()
    for _, t, s in ROWS:
        sizes[s] += count(t)
    want = brute_targets(sizes)
    left = Counter((i, count(t), sizes[s], s) for i, t, s in ROWS)
    taken, target = defaultdict(int), {}
    for r in rows:
        source = next(k[3] for k in left if k[:3] == (r.doc_id, r["size"], r.source_size) and left[k] and math.isclose(want[k[3]], r.target))
        left[(r.doc_id, r["size"], r.source_size, source)] -= 1
        taken[source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
        assert all(0 <= p.position <= 1 for p in r.passes)
        assert [p.position for p in r.passes] == sorted(p.position for p in r.passes)
    for s, t in want.items():
        assert taken[s] == math.floor(t + 1e-9) or abs(taken[s] - t) <= 1


def test_position_inverts_the_integral(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 101).select((F.col("id") / 100).alias("u"))
    for turn, knots in enumerate(mixture.SCHEDULES):
        for r in df.select("u", mixture.position(F.col("u"), F.lit(turn)).alias("t")).collect():
            total = done = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                total += (t1 - t0) * (w0 + w1) / 2
                if r.t > t0:
                    t = min(r.t, t1)
                    done += (t - t0) * (w0 + (w0 + (w1 - w0) * (t - t0) / (t1 - t0))) / 2
            assert math.isclose(done / total, r.u, abs_tol=1e-9)


def test_mix_repeats_rows_as_planned(docs):
    planned = Counter()
    for r in mixture.plan(docs).collect():
        planned[(r.doc_id, r["size"])] += len(r.passes)
    mixed = mixture.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, len((r.text or "").split())) for r in mixed.collect())
    assert got == +planned


def test_reruns_agree_and_empty(spark, docs):
    a = sorted(map(str, mixture.plan(docs).collect()))
    assert a == sorted(map(str, mixture.plan(docs.repartition(7)).collect()))
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture.plan(empty).count() == 0 and mixture.mix(empty).count() == 0


def test_matches_oracle(spark):
    r = compare(E.queries()["op8_mixture"](spark, SF), duck_connection(SF), E.oracle_sql()["op8_mixture"])
    assert r["ok"], r


def test_rows_that_differ_only_in_which_column_is_null_stay(spark):
    rows = [(1, "a b c", "x", None, 1.0), (1, "a b c", None, "x", 1.0), (1, "a b c", "x", None, 1.0), (2, "d", "1:x", None, None),
            (2, "d", "1", ":x", None), (2, "d", None, None, 0.1)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, note string, score double, source string")
    # one source is wanted whole
    assert Counter(tuple(r)[:5] for r in mixture.mix(docs).collect()) == Counter(rows)
    # and two sources that only their null column tells apart
    swapped = [(1, "a b c", "x", None), (1, "a b c", None, "x")]
    docs = spark.createDataFrame(swapped, "doc_id long, text string, lang string, source string")
    passes = {r["source_size"]: None for r in mixture.plan(docs).collect()}
    got = Counter(map(tuple, mixture.mix(docs).collect()))
    assert passes == {3: None} and set(got) == set(swapped)


def test_row_digests_tell_values_apart(spark):
    from datetime import datetime

    from tessera.llm.common import row_digest
    rows = [(None, "a", [1, None], datetime(2020, 1, 1, 0, 0, 0, 1), b"a", {"k": 1.5}), ("a", None, [1, None], datetime(2020, 1, 1, 0, 0, 0, 1), b"a", {"k": 1.5}),
            ("a", "", [1, None], datetime(2020, 1, 1, 0, 0, 0, 1), b"a", {"k": 1.5}), ("a", "", [1, None], datetime(2020, 1, 1, 0, 0, 0, 2), b"a", {"k": 1.5}),
            ("a", "", [1], datetime(2020, 1, 1, 0, 0, 0, 2), b"a", {"k": 1.5}), ("a", "", None, None, b"b", {"k": 2.5}), ("a", "", [], None, None, None)]
    df = spark.createDataFrame(rows + rows[:2], "x string, y string, z array<int>, t timestamp, b binary, m map<string, double>")
    digests = [bytes(r[0]) for r in df.select(row_digest(df)).collect()]
    assert len(set(digests)) == len(rows) and digests[-2:] == digests[:2]
