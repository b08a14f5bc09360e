"""Centroid clustering in integers, filtered in a rotation by PCA.

One pass over the vectors gives their covariance, whose eigenvectors rotate
them. Of every vector the leading rotated coordinates and the norm of the rest
are stored beside its integers. Between a vector and a centroid, the squared
distance of the leading coordinates plus the squared difference of the two
norms is never above the squared distance, so it rules out centroids; the
centroid of the least bound and all that may be as near are compared in
integers. Each round is one pass over the stored table and brings a sum for
every (centroid, component) to the driver.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.llm.common import integer_rows, list_matrix, prepare, stored

LONG_MAX = (1 << 63) - 1
#: Vectors that are compared at a time.
ROWS = 4096
#: Bounds give way by this share of the norms, far more than rounding takes.
SLACK = 2.0 ** -20


class Rotation:
    """Leading principal axes, as many as hold ``share`` of the variance:
    rotates vectors and splits off the rest's norm."""

    def __init__(self, n: int, total: np.ndarray, gram: np.ndarray, share: float):
        self.mean = total / max(n, 1)
        values, axes = np.linalg.eigh(gram / max(n, 1) - np.outer(self.mean, self.mean))
        order = np.argsort(-values, kind="stable")
        held = np.cumsum(np.maximum(values[order], 0.0))
        self.axes = axes[:, order[:int(np.searchsorted(held, share * held[-1])) + 1]] if len(held) else axes

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        moved = vectors.astype(np.float64) - self.mean
        leading = moved @ self.axes
        rest = (moved * moved).sum(axis=1) - (leading * leading).sum(axis=1)
        return leading, np.sqrt(np.maximum(rest, 0.0))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row; what is beyond a long counts as its maximum."""
    top = int(np.abs(a.astype(np.float64)).max(initial=0)) + int(np.abs(b.astype(np.float64)).max(initial=0)) + 1
    if top * top * max(a.shape[1], 1) < 1 << 62:
        d = a - b
        return np.einsum("ij,ij->i", d, d)
    d = a.astype(object) - b.astype(object)
    return np.minimum((d * d).sum(axis=1), LONG_MAX).astype(np.int64)


def nearest(vectors: np.ndarray, leading: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotation: Rotation
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, centroids compared in integers) of each
    vector; ties to the smaller centroid number."""
    at, own_rest = rotation(centroids)
    gap = np.square(leading).sum(axis=1)[:, None] + np.square(at).sum(axis=1) - 2 * (leading @ at.T)
    bound = np.sqrt(np.maximum(gap, 0.0) + np.square(rest[:, None] - own_rest))
    far = np.sqrt(np.square(vectors.astype(np.float64)).sum(axis=1))[:, None] + np.sqrt(np.square(centroids.astype(np.float64)).sum(axis=1))
    shift = float(np.sqrt(np.square(rotation.mean).sum()))
    bound -= SLACK * (far + 2 * shift) + 1e-9
    first = bound.argmin(axis=1)
    every = np.arange(len(vectors))
    distance = np.full(bound.shape, LONG_MAX, np.int64)
    distance[every, first] = squared(vectors, centroids[first])
    near = bound <= np.sqrt(distance[every, first].astype(np.float64))[:, None]
    near[every, first] = False
    row, other = np.nonzero(near)
    for low in range(0, len(row), ROWS):
        r, c = row[low:low + ROWS], other[low:low + ROWS]
        distance[r, c] = squared(vectors[r], centroids[c])
    best = distance.argmin(axis=1)
    # A distance beyond a long ties with the cells that were ruled out; the first compared one stands for it.
    best = np.where(distance[every, best] == LONG_MAX, np.where(near.any(axis=1), np.minimum(near.argmax(axis=1), first), first), best)
    return best, distance[every, best], near.sum(axis=1) + 1


def cluster_vectors(df: DataFrame, id_col: str, vector: str, k: int = 8, rounds: int = 10, scale: float = 1024.0,
                    dim: int = 64, seed: int = 3, share: float = 0.9) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    compared): the cluster of every vector of ``dim`` components after
    ``rounds`` rounds of assigning all vectors to the nearest centroid and
    moving every centroid to the floor of its vectors' mean.

    A component x counts as floor(scale * x), x as double, clamped to the long
    range. Centroids start as the ``k`` vectors (all, if fewer) of the smallest
    sha256 of ``seed:id``, equal ones in the order of their vectors, null ids
    last. Rows whose vector is null, of another length, or holds a null or
    non-finite component take no part; a null id does. Repeated rows are rows
    of their own. A centroid without vectors stays. Distances and inertias
    beyond a long count as its maximum. An empty table gives no rows. Other
    columns are not read. ``share``: of the variance that the leading rotated
    coordinates hold; ``compared``: how many centroids their bounds left.
    """
    spark = prepare(df)
    rows = integer_rows(df, vector, scale, id=F.col(f"`{id_col}`")).filter(F.col("dim") == dim).select("id", "vec")

    def products(batches):
        n, total, gram = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                x = list_matrix(batch.column(0).slice(low, ROWS), dim).astype(np.float64)
                n, total, gram = n + len(x), total + x.sum(axis=0), gram + x.T @ x
        values = np.concatenate([[float(n)], total, gram.ravel()])
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(values)), pa.int32()), "value": values})

    sums = {r["at"]: r.value for r in rows.select("vec").mapInArrow(products, "at int, value double")
            .groupBy("at").agg(F.sum("value").alias("value")).collect()}  # 1 + dim + dim * dim numbers
    flat = np.array([sums.get(i, 0.0) for i in range(1 + dim + dim * dim)])
    rotation = Rotation(int(flat[0]), flat[1:1 + dim], flat[1 + dim:].reshape(dim, dim), share)

    def rotate(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                y, rest = rotation(list_matrix(part.column(1), dim))
                cut = pa.array(np.arange(part.num_rows + 1) * y.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(cut, pa.array(y.ravel(), pa.float32())), pa.array(rest, pa.float32())],
                    ["id", "vec", "leading", "rest"])

    schema = T.StructType([*rows.schema.fields, T.StructField("leading", T.ArrayType(T.FloatType())), T.StructField("rest", T.FloatType())])
    rotated = stored(rows.mapInArrow(rotate, schema), "centroid-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rotated.select("vec", order.alias("digest")).orderBy(F.col("digest").asc_nulls_last(), "vec").limit(k).collect()
    centroids = np.array([r.vec for r in first], np.int64).reshape(len(first), dim)

    def compared(batch: pa.RecordBatch, now: np.ndarray):
        """vectors and the result of ``nearest``, of ROWS rows at a time."""
        for low in range(0, batch.num_rows, ROWS):
            part = batch.slice(low, ROWS)
            x = list_matrix(part.column(1), dim)
            y = list_matrix(part.column(2), rotation.axes.shape[1]).astype(np.float64)
            yield part, x, *nearest(x, y, part.column(3).to_numpy().astype(np.float64), now, rotation)

    def moved(now: np.ndarray) -> np.ndarray:
        def sums(batches):
            n, total = np.zeros(len(now), np.int64), np.zeros((len(now), dim), object)
            for batch in batches:
                for _, x, best, _, _ in compared(batch, now):
                    n += np.bincount(best, minlength=len(now))
                    x = x if np.abs(x.astype(np.float64)).max(initial=0) < 2.0 ** 50 else x.astype(object)
                    for c in np.unique(best):
                        total[c] += x[best == c].sum(axis=0)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(some, dim), pa.int32()), pa.array(np.tile(np.arange(dim), len(some)), pa.int32()),
                 pa.array([Decimal(int(t)) for t in total[some].ravel()], pa.decimal128(38, 0)), pa.array(np.repeat(n[some], dim))],
                ["cluster", "at", "total", "n"])

        out = now.copy()
        parts = rotated.mapInArrow(sums, "cluster int, at int, total decimal(38,0), n long")
        for r in parts.groupBy("cluster", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # k * dim rows
            out[r.cluster, r["at"]] = int(r.total) // r.n
        return out

    for _ in range(rounds if len(centroids) else 0):
        after = moved(centroids)
        if (after == centroids).all():
            break  # all further rounds would repeat this one
        centroids = after

    def assign(batches):
        for batch in batches:
            for part, _, best, distance, n in compared(batch, centroids):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, pa.int32()), pa.array(distance), pa.array(n, pa.int32())],
                                                 ["vec_id", "cluster", "distance", "compared"])

    kind = T.StructType([T.StructField("vec_id", rows.schema["id"].dataType), T.StructField("cluster", T.IntegerType()),
                         T.StructField("distance", T.LongType()), T.StructField("compared", T.IntegerType())])
    assigned = stored(rotated.mapInArrow(assign, kind), "centroid-assigned")
    inertia = {r.cluster: int(r.d) for r in
               assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    every = min(sum(inertia.values()), LONG_MAX)
    facts = [(c, min(d, LONG_MAX), every, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, d in sorted(inertia.items())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), "cluster")  # one row a centroid
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"))
