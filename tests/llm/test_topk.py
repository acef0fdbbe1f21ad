import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.llm import topk
from tests.oracle import compare, duck_connection


def brute(rows, is_query, k=10):
    """Every row is a candidate of every other one, whatever their ids."""
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (q, a) in enumerate(ok):
        if is_query(q):
            scores = sorted((-sum(x * y for x, y in zip(a, w)), i) for n, (i, w) in enumerate(ok) if n != own)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2, 7), (256, 8192)])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    f32 = lambda a: [float(np.float32(x)) for x in a]
    rows = [(i, f32(rng.normal(size=8) * (rng.random(8) < 0.5))) for i in range(120)]
    rows += [(200 + i, f32([0.5] * 8)) for i in range(40)]              # equal vectors: ties
    rows += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan")]), (303, [float("inf")]), (304, []), (305, [1.0]),
             (None, [1.0] * 8), (10, rows[10][1]), (20, f32([9.0] * 8))]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "vec_id long, embedding array<float>, q int, w string")
    got = topk.top_k(df, F.col("id") % 10 == 0, query_block=blocks[0], candidate_block=blocks[1]).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 10 == 0)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.col("id") == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.top_k(df.limit(0), F.col("id") == 0).count() == 0


def test_rows_that_repeat_an_id_stay(spark):
    df = spark.createDataFrame([(100, [1.0]), (1, [0.5]), (1, [2.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, F.col("id") == 100).collect()))
    assert got == [(100, 1, 1, 2 * 1024 ** 2), (100, 2, 2, 1024 ** 2), (100, 3, 1, 1024 ** 2 // 2)]
    twice = spark.createDataFrame([(100, [1.0]), (100, [1.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(twice, F.col("id") == 100).collect()))
    assert got == [(100, 1, 3, 1024 ** 2)] * 2 + [(100, 2, 100, 1024 ** 2)] * 2


def test_sql_agrees_on_repeated_ids_and_empty_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 40)) * 10, [float(np.float32(x)) for x in rng.normal(size=rng.integers(0, 5))]) for _ in range(150)]
    df = spark.createDataFrame(rows + [(None, [1.0]), (100, None), (200, [None])], "vec_id long, embedding array<float>")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = sorted(map(tuple, E.queries()["op2_topk"](spark, str(tmp_path)).collect()))
    assert got == sorted(con.sql(E.oracle_sql()["op2_topk"]).fetchall())


def test_matches_oracle(spark):
    sf = "/root/testdata/sf0.01"
    r = compare(E.queries()["op2_topk"](spark, sf), duck_connection(sf), E.oracle_sql()["op2_topk"])
    assert r["ok"], r
