"""Hard negatives against a plain search, and the residue products against exact ones."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadscope.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vec string, rank string"


def brute(rows, low=80, high=100, scale=256):
    kept = {(i, y, tuple(math.floor(scale * x) for x in v)) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, y, q in kept:
        if i % 10:
            continue
        score = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j, z) for j, z, c in kept if j != i and len(c) == len(q))
        for s, j, _ in [r for r in score if r[2] == y][:5]:
            inside = [r for r in score if r[2] != y and low * -s <= 100 * -r[0] <= high * -s][:5]
            out += [(i, j, n + 1, r[1], -s, -r[0]) for n, r in enumerate(inside)]
    return sorted(out)


def run(spark, rows, **opts):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    out = H.hard_negatives(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0, **opts)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def test_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0.2, 0.5) for _ in range(5)], rng.randrange(3)) for i in range(200)]
    rows += [(i, [0.5] * 5, i % 2) for i in range(200, 240)]  # ties
    rows += [rows[10], (10, rows[11][1], 1), (None, [0.5] * 5, 1), (400, None, 1), (401, [0.5] * 5, None), (402, [0.5, None], 0),
             (403, [float("nan")] * 5, 0), (410, [0.5, 0.5], 0), (411, [0.5, 0.4], 0), (412, [0.5, 0.45], 1), (420, [], 0), (421, [], 0),
             (422, [], 1), (430, [-0.5] * 5, 9)]
    want = brute(rows)
    assert len(want) > 200
    assert run(spark, rows) == want
    assert run(spark, rows, block_rows=30, anchor_rows=7) == want


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.5], 0), (2, [0.5], 1)]) == []  # no anchor


def test_components_beyond_a_long(spark):
    rows = [(0, [1e300, 1.0], 1), (1, [1e300, 2.0], 1), (2, [1e300, 1.0], 0)]
    assert run(spark, rows) == [(0, 1, 1, 2, H.LONG_MAX, H.LONG_MAX)]


@pytest.mark.parametrize("top, dim", [(0, 4), (5, 3), (160, 64), (30_000, 1500), (1 << 40, 5), (1 << 62, 3)])
def test_residue_products_are_exact(top, dim):
    rng = np.random.default_rng(7)
    a, b = (rng.integers(-top, top + 1, (6, dim)) for _ in range(2))
    a[0], b[0] = top, top
    a[1] = -top
    got = H.scores(a, b)
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()
    primes = H.primes_for(dim * top * top)
    assert math.prod(primes) > 2 * dim * top * top and all(p * p < H.FLOAT_INTEGERS for p in primes)
