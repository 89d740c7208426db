from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from wattspan.llm import topk


def slow(vectors, queries, k):
    out = []
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items()
                        if i != q and len(v) == len(vectors[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows, dim, spread", [(300, 6, 40), (300, 4, 1), (12, 3, 5), (3, 2, 5)])
def test_equals_brute_force(spark, rows, dim, spread):
    rng = random.Random(rows + spread)
    # With spread 1 most vectors are equal and most scores tie.
    vectors = {i: [rng.randint(-spread, spread) for _ in range(dim)] for i in range(rows)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, v array<bigint>")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, 4, shard_rows=70, block_queries=20)
    assert sorted(tuple(r) for r in got.collect()) == slow(vectors, range(0, rows, 5), 4)


def test_odd_vectors(spark):
    rows = [
        (0, [0.5, 0.25]), (1, [0.1, 0.2]), (1, [0.1, 0.2]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]),
        (5, [math.inf, 0.0]), (6, []), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [-0.5, 0.125]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("own"))
    kept = df.where(topk.complete(F.col("embedding")))
    whole = kept.select("vec_id", topk.whole_numbers(F.col("embedding")).alias("v"))
    got = sorted(tuple(r) for r in topk.top_k(whole, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 128 * 25 + 64 * 51), (0, 2, 8, -128 * 128 + 64 * 32)]
    assert topk.top_k(whole.where("false"), F.col("vec_id") == 0).count() == 0


def test_bounds_hold():
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = rng.integers(-50, 50, (500, 8))
    tree = topk.Tree(np.arange(500), vectors, leaf=16)
    queries = rng.integers(-50, 50, (20, 8))
    bounds = tree.bounds(queries.astype(float))
    for node, (lo, hi) in enumerate(tree.span):
        assert (queries @ tree.vectors[lo:hi].T <= bounds[:, [node]]).all()
