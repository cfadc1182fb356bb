import math

import pytest
from pyspark.sql import functions as F

from riskloom.llm import topk


def want(rows, k=5, every=50):
    ok = {}
    vecs = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * x) for x in v]
        vecs.append((i, w))
        if i % every == 0:
            ok[i] = min(ok.get(i, w), w)
    out = []
    for q, w in ok.items():
        best = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in vecs if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, score string, rank int")


@pytest.mark.parametrize("blocks", [{}, {"query_block": 2, "candidate_block": 7}])
def test_against_brute_force(spark, rng, blocks):
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, 0.125, 1.0]) for _ in range(8)]) for i in range(0, 400)]
    rows += [(i, rows[0][1]) for i in range(400, 460)]  # ties
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, **blocks)
    assert sorted(map(tuple, got.collect())) == want(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []),
            (6, [3.0]), (7, [1.0, 1.0, 9.0]), (50, [0.0, 0.0]), (50, [0.0, 1.0]), (None, [5.0, 5.0]), (8, [-1.0, 0.5])]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == want(rows)
    assert topk.top_k(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(frame(spark, [(50, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
