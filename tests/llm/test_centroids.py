"""Centroid clustering against plain integer rounds in Python."""
import hashlib
import math
import random

import numpy as np

from threadscope.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int, vec string, id string"


def brute(rows, k, rounds, dim, scale=1024):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    now = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(now))
    for _ in range(rounds):
        best = [near(v)[1] for _, v in kept]
        for j in set(best):
            own = [v for (_, v), b in zip(kept, best, strict=True) if b == j]
            now = [*now[:j], tuple(sum(x) // len(own) for x in zip(*own, strict=True)), *now[j + 1:]]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    part = {j: sum(d for _, c, d in out if c == j) for j in range(k)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, c, d, part[c], sum(part.values()), sha[c]) for i, c, d in out), key=repr)


def run(spark, rows, **opts):
    df = spark.createDataFrame([(i, v, "x", 1, "y", "z") for i, v in rows], SCHEMA).repartition(3)
    out = C.cluster_vectors(df, "vec_id", "embedding", **opts)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"]
    return sorted((tuple(r)[:6] for r in out.collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(4)
    centre = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in centre[i % 5]]) for i in range(200)]
    rows += [(i, [0.25] * 6) for i in range(200, 260)]  # ties, and centroids that stay empty
    rows += [rows[3], (3, rows[9][1]), (None, rows[5][1]), (300, None), (301, [0.5] * 5), (302, [0.5] * 5 + [None]),
             (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (305, []), (306, [-0.0] * 6)]
    for k, share in ((4, 0.5), (8, 1.0), (7, 0.0)):
        assert run(spark, rows, k=k, rounds=5, dim=6, share=share) == brute(rows, k, 5, 6)


def test_few_rows_and_none(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0])]
    assert run(spark, rows, k=8, rounds=3, dim=2) == brute(rows, 2, 3, 2)
    assert run(spark, [(1, None)], k=8, dim=2) == []
    assert C.cluster_vectors(spark.createDataFrame([], SCHEMA), "vec_id", "embedding").count() == 0


def test_vectors_beyond_a_long(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [1e300, 1.0])]
    got = run(spark, rows, k=2, rounds=2, dim=2)
    assert [r[0] for r in got] == [1, 2, 3] and all(0 <= r[2] <= C.LONG_MAX for r in got)


def test_bounds_rule_out_and_stay_exact():
    rng = np.random.default_rng(5)
    points = rng.integers(-300, 300, (20, 64))
    vectors = points[rng.integers(0, 20, 500)] + rng.integers(-20, 20, (500, 64))
    x = vectors.astype(float)
    rotation = C.Rotation(len(x), x.sum(axis=0), x.T @ x, 0.5)
    leading, rest = rotation(vectors)
    best, distance, compared = C.nearest(vectors, leading.astype(np.float32).astype(float), rest.astype(np.float32).astype(float), points, rotation)
    true = np.square(vectors[:, None, :] - points).sum(axis=2)
    assert (best == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
    assert rotation.axes.shape[1] < 20 and compared.mean() < 3  # of 20
