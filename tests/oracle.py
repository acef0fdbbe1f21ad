"""Spark-vs-DuckDB check of every registered query (what the driver's gate does).

Usage: ``python -m tests.oracle [sf_dir] [query ...]``.  Prints one line per
query: row counts, column names, column types and an order-insensitive value
comparison.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK_TYPES = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "float64",
                "StringType": "str", "BooleanType": "bool", "ShortType": "int16",
                "FloatType": "float32", "TimestampType": "ts", "ArrayType": "list",
                "StructType": "struct"}
_DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str",
               "BOOLEAN": "bool", "SMALLINT": "int16", "FLOAT": "float32", "TIMESTAMP": "ts"}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    # floats compare exactly: both engines apply the same IEEE operations
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _duck_type(t: str) -> str:
    t = str(t)
    if t.endswith("[]"):
        return "list"
    if t.startswith("STRUCT"):
        return "struct"
    return _DUCK_TYPES.get(t, t)


def compare(spark_df, con, sql: str) -> dict:
    t0 = time.time()
    s_rows = spark_df.collect()
    t_spark = time.time() - t0
    s_cols = spark_df.columns
    s_types = [_SPARK_TYPES.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_df.schema]
    t0 = time.time()
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_types = [_duck_type(t) for t in rel.types]
    d_rows = rel.fetchall()
    t_duck = time.time() - t0
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "t_spark": round(t_spark, 2), "t_oracle": round(t_duck, 2)}
    res["names_match"] = sorted(s_cols) == sorted(d_cols)
    res["types_match"] = dict(zip(s_cols, s_types)) == dict(zip(d_cols, d_types))
    if not res["types_match"]:
        res["types"] = (dict(zip(s_cols, s_types)), dict(zip(d_cols, d_types)))
    if res["names_match"]:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
        dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
        res["values_match"] = sc == dc
        if not res["values_match"]:
            res["only_spark"] = list((sc - dc).elements())[:3]
            res["only_oracle"] = list((dc - sc).elements())[:3]
    else:
        res["values_match"] = False
        res["columns"] = (s_cols, d_cols)
    res["ok"] = res["values_match"] and res["types_match"] and res["spark_rows"] == res["oracle_rows"]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from tessera.session import build_session

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in oracles:
            df = qs[name](spark, sf_dir)
            print(f"{name:28s} NO-ORACLE rows={df.count()}")
            continue
        try:
            r = compare(qs[name](spark, sf_dir), con, oracles[name])
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(f"{name:28s} {'OK ' if r['ok'] else 'BAD'} {r}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
