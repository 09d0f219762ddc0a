"""Exact top-k against all products."""

import math
import random

import pytest
from pyspark.sql import functions as F

from encore.llm import pivots
from encore.llm.queries import op11_pivots


def brute(rows, queries, k, scale=64):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = lambda v: [math.floor(scale * x) for x in v]
    rows = [(i, ints(v)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q, v in queries:
        if q is None or not usable(v):
            continue
        best = out.setdefault(q, {})
        for i, x in rows:
            if i != q:
                s = sum(a * b for a, b in zip(ints(v), x))
                best[i] = max(best.get(i, s), s)
    return sorted((q, r, i, s) for q, best in out.items()
                  for r, (s, i) in enumerate(sorted(((s, i) for i, s in best.items()),
                                                    key=lambda p: (-p[0], p[1]))[:k], 1))


def _got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def _table(spark, rows):
    # extra columns with names that the operator uses itself
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, near string, block int")


def _rows(seed, n=400, dims=6):
    rnd = random.Random(seed)
    f = lambda: rnd.randrange(-64, 64) / 64         # exact as a float
    rows = [(i, [f() for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, list(rows[3][1])) for i in range(n // 3)]                  # a group of copies
    rows += [(5, [f() for _ in range(dims)]), rows[7], rows[20], (20, [0.0] * dims)]     # repeated ids and rows
    rows += [(9001, None), (9002, []), (9003, [0.5, None]), (9004, [float("nan")] * dims), (9005, [float("inf")]),
             (None, [1.0] * dims), (9020, [0.25, 0.5])]
    return rows


@pytest.mark.parametrize("seed,k,block,count", [(1, 5, 4096, 32), (2, 20, 16, 4), (3, 3, 50, 1)])
def test_equals_all_products(spark, seed, k, block, count):
    rows = _rows(seed)
    df = _table(spark, rows).repartition(5)
    got = _got(pivots.top_k(df, df.filter("vec_id % 20 = 0"), k=k, block=block, count=count))
    assert got == brute(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], k)


def test_large_components_few_rows_and_empty_tables(spark):
    rows = [(20 * i, [float(3 * 2 ** i * s) for s in (1, -1, 1)]) for i in range(23)]      # sums beyond 2**53
    df = _table(spark, rows)
    assert _got(pivots.top_k(df, df, k=30)) == brute(rows, rows, 30)
    none = df.limit(0)
    assert pivots.top_k(none, none).count() == 0
    assert pivots.top_k(none, df).count() == 0
    assert pivots.top_k(df, none).count() == 0
    same = _table(spark, [(i, [0.5, 0.5]) for i in range(50)])
    assert _got(pivots.top_k(same, same.filter("vec_id = 20"), k=3)) == [(20, 1, 0, 2048), (20, 2, 1, 2048), (20, 3, 2, 2048)]


def test_query_answers_every_twentieth_row(spark):
    root = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{root}/embeddings.parquet")
            .select("vec_id", F.col("embedding").cast("array<double>")).collect()]
    assert _got(op11_pivots(spark, root)) == brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
