import numpy as np
import pytest
from pyspark.sql import functions as F

from steploom.llm.topk import SearchConfig, inner_products, quantized, search_top_k, upper_bounds

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    """rows and queries: (id, integer vector)."""
    out = []
    for q, v in queries:
        scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows, chunk", [(7, 3), (512, 4096)])
def test_matches_brute_force(spark, block_rows, chunk):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(0, 1, 8).astype("f4")]) for i in range(400)]
    rows += [(400 + i, rows[5][1]) for i in range(60)]  # ties
    df = spark.createDataFrame([(*x, 0) for x in rows], SCHEMA).repartition(5)
    vectors = df.select("vec_id", quantized(F.col("embedding")).alias("vector"))
    got = search_top_k(vectors, vectors.where("vec_id % 20 = 0"), SearchConfig(block_rows=block_rows, query_chunk=chunk))
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(whole, [x for x in whole if x[0] % 20 == 0], 10)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -2.0]), (1, [0.5, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0]),
        (None, [9.0, 9.0]), (8, [0.0, -0.0004]), (9, [0.5, 0.0]), (9, [0.5, 0.0]),
    ]
    vectors = spark.createDataFrame([(*x, 0) for x in rows], SCHEMA).select("vec_id", quantized(F.col("embedding")).alias("vector"))
    got = sorted(map(tuple, search_top_k(vectors, vectors.where("vec_id = 0")).collect()))
    # An empty vector takes part with score 0, repeated rows are candidates each, a shorter vector goes on with zeros.
    assert got == [
        (0, 1, 7, 1024 * 1024), (0, 2, 1, 512 * 1024), (0, 3, 9, 512 * 1024), (0, 4, 9, 512 * 1024), (0, 5, 8, 2048), (0, 6, 6, 0),
    ]


def test_empty(spark):
    vectors = spark.createDataFrame([], SCHEMA).select("vec_id", quantized(F.col("embedding")).alias("vector"))
    assert search_top_k(vectors, vectors).collect() == []


def test_large_values_are_exact():
    a = np.array([[2.0**40, 3.0], [2.0**61, 1.0]])
    b = np.array([[2.0**20 + 1, 5.0], [4.0, -7.0]])
    assert inner_products(a[:1], b).tolist() == [[2**60 + 2**40 + 15, 2**42 - 21]]
    assert inner_products(a[1:], b).tolist() == [[2**63 - 1, 2**63 - 8 + 1]]


def test_bounds_hold():
    r = np.random.default_rng(4)
    q, v = r.normal(0, 100, (20, 6)).round(), r.normal(0, 100, (50, 6)).round()
    bound = upper_bounds(q, v.max(0)[None, :], v.min(0)[None, :])[:, 0]
    assert (bound >= (q @ v.T).max(1)).all()
