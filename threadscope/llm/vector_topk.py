"""Exact top-k search by integer inner product: one KD-tree per shard.

Vectors are dealt to shards of bounded size by a hash. Each shard becomes a
KD-tree: median splits along the widest side, with a tight bounding box for
every node. A query is searched best-first: nodes wait in a heap by the upper
bound that their box gives for the query's score, and the search ends when
the best bound cannot beat the k-th best score. All queries are searched in
shard 0 first; the k-th scores from there go into the searches of all other
shards, which run in parallel, one (shard, block of queries) cell a group.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadscope.llm.common import prepare, stored

LONG_MAX = (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str, vector: str, scale: float) -> DataFrame:
    """(id, vec, dim): floor(scale * x) of each component x, as a double (a
    result outside the long range is clamped to it). Rows without an id or a
    vector, or with a null or non-finite component, take no part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x"))
            .filter(F.col("id").isNotNull() & F.col("x").isNotNull())
            .withColumn("odd", F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
            .filter(~F.coalesce("odd", F.lit(True)))
            .select("id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("vec"),
                    F.size("x").alias("dim")))


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int) -> dict:
    """Points reordered by median splits, and one row a node: its range of
    points, children (-1: a leaf), tight box and smallest id."""
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], points[order]
    place = np.arange(len(ids))
    nodes: list[list[int]] = []
    low, high = [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        here = len(nodes)
        nodes.append([start, end, -1, -1])
        if parent >= 0:
            nodes[parent][2 + side] = here
        box = points[place[start:end]]
        low.append(box.min(axis=0))
        high.append(box.max(axis=0))
        if end - start <= leaf or not box.shape[1]:
            continue
        width = high[-1].astype(np.float64) - low[-1]
        axis = int(width.argmax())
        if not width[axis]:
            continue  # equal points: no box can split them further
        middle = (end - start) // 2
        place[start:end] = place[start:end][np.argpartition(box[:, axis], middle)]
        todo += [(start, start + middle, here, 0), (start + middle, end, here, 1)]
    ids, points = ids[place], points[place]
    shape = np.array(nodes, np.int64)
    return {"ids": ids, "points": points, "nodes": shape, "low": np.array(low), "high": np.array(high),
            "least": np.array([ids[s:e].min() for s, e in shape[:, :2]])}


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where these hold every sum, else in
    Python's integers, clamped to the long range."""
    top = (float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
           * max(a.shape[-1], 1))
    if top < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.astype(object)
    return np.clip(exact, -LONG_MAX - 1, LONG_MAX).astype(np.int64)


def search(tree: dict, queries: np.ndarray, own: np.ndarray, k: int, kth: list) -> list[list[tuple[int, int]]]:
    """Best (score, id) pairs of each query among the tree's points, without
    those of the query's own id. ``kth``: for each query a (score, id) that k
    candidates elsewhere reach, or None; what is worse is left out."""
    ids, points, nodes, least = tree["ids"], tree["points"], tree["nodes"], tree["least"]
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    top = (np.abs(queries.astype(np.float64)).max(initial=0)
           * max(np.abs(tree["low"].astype(np.float64)).max(initial=0), np.abs(tree["high"].astype(np.float64)).max(initial=0))
           * max(queries.shape[1], 1))
    if top < 2.0 ** 52:
        flat = points.astype(np.float64)
        bounds = (positive.astype(np.float64) @ tree["high"].T.astype(np.float64)
                  + negative.astype(np.float64) @ tree["low"].T.astype(np.float64)).astype(np.int64)
    else:
        flat = None
        bounds = np.clip(positive.astype(object) @ tree["high"].T.astype(object)
                         + negative.astype(object) @ tree["low"].T.astype(object),
                         -LONG_MAX - 1, LONG_MAX).astype(np.int64)
    found = []
    for i in range(len(queries)):
        bound, me = bounds[i].tolist(), int(own[i])
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
        limit = (kth[i][0], -kth[i][1]) if kth[i] else None
        query = queries[i].astype(np.float64) if flat is not None else queries[i]
        heap = [(-bound[0], int(least[0]), 0)]
        while heap:
            up, low_id, node = heapq.heappop(heap)
            if limit is not None and (-up, -low_id) < limit:
                if -up < limit[0]:
                    break
                continue
            start, end, left, right = nodes[node].tolist()
            if left >= 0:
                for child in (left, right):
                    if limit is None or bound[child] >= limit[0]:
                        heapq.heappush(heap, (-bound[child], int(least[child]), child))
                continue
            score = (flat[start:end] @ query).astype(np.int64) if flat is not None else _product(points[start:end], query)
            others = ids[start:end] != me
            at = np.flatnonzero(others & (score >= limit[0]) if limit is not None else others)
            if len(at) > k:
                at = at[np.lexsort((ids[start + at], -score[at]))[:k]]
            for s, d in zip(score[at].tolist(), ids[start + at].tolist(), strict=True):
                if limit is not None and (s, -d) < limit:
                    continue
                heapq.heappush(best, (s, -d))
                if len(best) > k:
                    heapq.heappop(best)
                if len(best) == k and (limit is None or best[0] > limit):
                    limit = best[0]
        found.append([(s, -d) for s, d in best])
    return found


def top_k(df: DataFrame, id_col: str, vector: str, is_query: Column, k: int = 10, scale: float = 1024.0,
          shard_rows: int = 8192, block_rows: int = 1024, leaf: int = 128) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` selects,
    the k other rows with the highest integer inner product, ties to the
    smaller id; all of them if there are fewer.

    Ids name vectors: rows that repeat an id and a vector count once, and a
    row is no candidate for a query of its id. Only vectors of one length are
    compared. Vectors of no components score 0. Scores are exact; one beyond
    the long range is clamped to it. Null ids, null vectors, and null or
    non-finite components take no part; an empty table gives no rows. Other
    columns are not read.
    """
    spark = prepare(df)
    plain = integer_vectors(df, id_col, vector, scale)
    chosen = integer_vectors(df.filter(is_query), id_col, vector, scale)
    n, asked = plain.count(), chosen.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // block_rows))
    key = F.xxhash64("id", "vec")

    def grow(group: pa.Table) -> pa.Table:
        dim = group["dim"][0].as_py()
        points = group["vec"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, dim)
        tree = pickle.dumps(build_tree(group["id"].to_numpy(), points, leaf))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([group["shard"][0].as_py()], pa.int64()),
                         "tree": pa.array([tree], pa.binary())})

    trees = (plain.distinct().withColumn("shard", F.pmod(key, F.lit(shards)).cast("long"))
             .groupBy("dim", "shard").applyInArrow(grow, "dim int, shard long, tree binary"))
    trees = stored(trees, "kd-trees")
    queries = (chosen.distinct().withColumn("block", F.pmod(key, F.lit(blocks)).cast("long"))
               .withColumn("qkey", F.xxhash64("vec")))

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "qkey": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            tree = pickle.loads(left["tree"][0].as_py())
            dim = left["dim"][0].as_py()
            vectors = right["vec"].combine_chunks().flatten().to_numpy().reshape(right.num_rows, dim)
            kth = [None if s is None else (s, d) for s, d in
                   zip(right["kth_score"].to_pylist(), right["kth_id"].to_pylist(), strict=True)]
            own, qkey = right["id"].to_numpy(), right["qkey"].to_pylist()
            for i, pairs in enumerate(search(tree, vectors, own, k, kth)):
                for s, d in pairs:
                    for name, v in (("query_id", int(own[i])), ("qkey", qkey[i]), ("vec_id", d), ("score", s)):
                        out[name].append(v)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    def cells(some_trees: DataFrame, asked_rows: DataFrame) -> DataFrame:
        grid = ["dim", "shard", "block"]
        left = some_trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return left.groupBy(*grid).cogroup(asked_rows.groupBy(*grid)).applyInArrow(
            visit, "query_id long, qkey long, vec_id long, score long")

    none = F.lit(None).cast("long")
    seeds = cells(trees.filter("shard = 0"), queries.withColumns(
        {"shard": F.lit(0).cast("long"), "kth_score": none, "kth_id": none}))
    seeds = stored(seeds, "kd-seeds")
    found = seeds
    if shards > 1:
        worst = (seeds.groupBy("query_id", "qkey")
                 .agg(F.min(F.struct("score", (-F.col("vec_id")).alias("less"))).alias("w"), F.count("*").alias("n"))
                 .filter(F.col("n") >= k)
                 .select(F.col("query_id").alias("id"), "qkey", F.col("w.score").alias("kth_score"),
                         (-F.col("w.less")).alias("kth_id")))
        rest = (queries.join(worst, ["id", "qkey"], "left")
                .withColumn("shard", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(shards - 1).cast("long")))))
        found = seeds.union(cells(trees.filter("shard > 0"), rest))
    order = Window.partitionBy("query_id", "qkey").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
