"""Top-k search against a brute-force product of all pairs."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from threadscope.llm import vector_topk as V


def brute(rows, k, scale=1024):
    ok = {(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, q in ok:
        if i % 10 == 0:
            all_ = sorted(((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in ok if j != i and len(c) == len(q)))
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(all_[:k])}
    return out


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]  # one very common vector: ties
    rows += [rows[10], (500, None), (510, [1.0, None]), (520, [float("nan")] * 8), (530, [float("inf")] + [0.0] * 7),
             (None, [1.0] * 8), (540, [1.0, 2.0]), (541, [2.0, 1.0]), (550, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, score int")
    got = V.top_k(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0, k=5, shard_rows=64, block_rows=16, leaf=8)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute(rows, 5)


def test_an_id_with_many_vectors(spark):
    rng = random.Random(8)
    rows = [(10, [1.0 + i / 64, 1.0, 1.0]) for i in range(15)] + [(i, [rng.random() for _ in range(3)]) for i in range(11, 41) if i % 10]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = V.top_k(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0).collect()
    assert len(got) == 150 and {tuple(r) for r in got} == brute(rows, 10)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.top_k(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0).count() == 0


def test_tree_prunes_and_is_exact():
    rng = np.random.default_rng(2)
    points = rng.integers(-1000, 1000, (500, 3))
    tree = V.build_tree(np.arange(500), points, 16)
    for node, (s, e, left, right) in enumerate(tree["nodes"]):
        assert (tree["points"][s:e].min(axis=0) == tree["low"][node]).all()  # tight boxes
        assert (tree["points"][s:e].max(axis=0) == tree["high"][node]).all()
        assert left < 0 or tree["nodes"][left][1] == tree["nodes"][right][0]
    query = np.array([[3, -2, 1]])
    score = points @ query[0]
    best = sorted((-s, i) for i, s in enumerate(score.tolist()))[:7]
    assert sorted((-s, i) for s, i in V.search(tree, query, np.array([-1]), 7, [None])[0]) == best
    assert V.search(tree, query, np.array([-1]), 7, [(10**9, 0)])[0] == []  # nothing reaches that k-th score


def test_scores_beyond_doubles():
    a, b = np.array([[1 << 40, 1]]), np.array([[1 << 22], [1]])
    assert V._product(a, b)[0, 0] == (1 << 62) + 1
    assert V._product(a * 4, b)[0, 0] == V.LONG_MAX
