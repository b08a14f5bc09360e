"""Hard negatives from exact scores by a residue-number-system matrix product.

Integer vectors are reduced modulo a few primes below 256. Products of the
residues stay below 2 ** 24, so float32 matrix products give them exactly, one
a prime, and Chinese remaindering puts the signed scores together. Rows and
anchors are packed into blocks; every (block of anchors, block of rows) cell is
one group. A first pass over the cells finds each anchor's positives, a second
one selects, in the window that each positive's score sets, its negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadscope.llm.common import integer_rows, list_matrix, prepare, stored

LONG_MAX = (1 << 63) - 1
#: Primes below 256, the largest first.
PRIMES = [p for p in range(255, 2, -1) if all(p % q for q in range(2, 16))]
#: float32 holds all integers up to here.
FLOAT_INTEGERS = 1 << 24
#: Anchors whose scores lie in memory at a time.
ANCHORS = 256


def _residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, from -p / 2 to p / 2."""
    r = np.mod(x, p).astype(np.int64)
    return (r - p * (r > p // 2)).astype(np.float32)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))


def primes_for(bound: int) -> list[int]:
    """As many primes as tell apart all integers from -bound to bound."""
    chosen, product = [], 1
    for p in PRIMES:
        if product > 2 * bound:
            break
        chosen, product = [*chosen, p], product * p
    return chosen


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``: longs, or
    Python's integers where a long may not hold a hundred times their bound."""
    bound = max(a.shape[1], 1) * _largest(a) * _largest(b)
    kind = np.int64 if bound < 1 << 54 else object
    total, product = np.zeros((len(a), len(b)), kind), 1
    for p in primes_for(bound):
        left, right = _residues(a, p), _residues(b, p)
        step = FLOAT_INTEGERS // (p // 2) ** 2  # components whose products sum up exactly
        rest = np.zeros(total.shape, np.int32)
        for low in range(0, a.shape[1], step):
            rest += np.mod((left[:, low:low + step] @ right[:, low:low + step].T).astype(np.int32), p)
            rest %= p
        # The next digit in the mixed radix of the primes.
        total += np.mod((rest - total % p) * pow(product, -1, p), p).astype(kind) * product
        product *= p
    total[total > product // 2] -= product
    return total


def first_of(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k of the places ``at`` with the highest scores, ties to the smaller place."""
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        above = at[score[at] > least]
        at = np.concatenate([above, at[score[at] == least][:k - len(above)]])
    return at[np.lexsort((at, -score[at]))]


def positives_of(score: np.ndarray, same: np.ndarray, k: int):
    """Places of the first ``k`` rows of the same label, for each anchor."""
    for s, mine in zip(score, same, strict=True):
        yield first_of(s, np.flatnonzero(mine), k)


def negatives_of(score: np.ndarray, other: np.ndarray, positive: list[list[int]], low: int, high: int, k: int):
    """For each anchor and each of its positives' scores, the places of the first
    ``k`` rows of another label whose score lies in the positive's window."""
    for s, theirs, own in zip(score, other, positive, strict=True):
        hundred = 100 * s
        yield [first_of(s, np.flatnonzero(theirs & (hundred >= low * p) & (hundred <= high * p)), k) for p in own]


def _packed(rows: DataFrame, block: str, columns: list[str]) -> DataFrame:
    """One row a block: (dim, block, rows), the block's rows in order of their id as an Arrow stream."""
    def pack(group: pa.Table) -> pa.Table:
        ordered = group.select(columns).sort_by([("id", "ascending"), ("key", "ascending")]).combine_chunks()
        vec = ordered["vec"].combine_chunks()
        flat, most = vec.flatten().to_numpy(), _largest(vec.flatten().to_numpy())
        narrow = next((t for t in (np.int8, np.int16, np.int32) if most <= np.iinfo(t).max), np.int64)
        cut = pa.array(np.arange(len(vec) + 1) * group["dim"][0].as_py(), pa.int32())
        ordered = ordered.set_column(columns.index("vec"), "vec", pa.ListArray.from_arrays(cut, pa.array(flat.astype(narrow))))
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, ordered.schema) as stream:
            stream.write_table(ordered)
        return pa.table({"dim": group["dim"].slice(0, 1), block: group[block].slice(0, 1),
                         "rows": pa.array([out.getvalue().to_pybytes()], pa.binary())})

    return rows.select(*columns, "dim", block).groupBy("dim", block).applyInArrow(pack, f"dim int, {block} long, rows binary")


def _unpacked(cell: pa.Table, dim: int) -> tuple[pa.Table, np.ndarray]:
    rows = pa.ipc.open_stream(cell["rows"][0].as_py()).read_all().combine_chunks()
    return rows, list_matrix(rows["vec"].combine_chunks(), dim).astype(np.int64)


def hard_negatives(df: DataFrame, id_col: str, vector: str, label: Column, is_anchor: Column, positives: int = 5,
                   negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0, block_rows: int = 8192,
                   anchor_rows: int = 1024) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is its integer inner product with the anchor; a component x
    counts as floor(scale * x), x as double, clamped to the long range. An
    anchor (a row that ``is_anchor`` selects) has as positives its first
    ``positives`` other rows of its ``label``, and for each of them come the
    first ``negatives`` rows of another label with low * positive_score <= 100 *
    negative_score <= high * positive_score (all, if there are fewer), by
    falling score, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component
    take no part. Rows alike in id, label and vector count once, and a row is
    neither positive nor negative of an anchor of its id; an id with several
    vectors is several anchors. Only vectors of one length are compared; those
    of no components score 0. Scores are exact, one beyond the long range counts
    as its end. An empty table gives no rows. Other columns are not read.
    """
    spark = prepare(df)
    rows = integer_rows(df, vector, scale, id=F.col(f"`{id_col}`").cast("long"), label=label, anchor=F.coalesce(is_anchor, F.lit(False)))
    rows = rows.filter("id is not null and label is not null").distinct().withColumn("key", F.xxhash64("label", "vec", "dim"))
    rows = stored(rows, "negatives-rows")
    n = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0)).alias("anchors")).first()
    blocks, groups = max(1, -(-n.rows // block_rows)), max(1, -(-n.anchors // anchor_rows))
    deal = F.xxhash64("id", "key")
    every = stored(_packed(rows.withColumn("block", F.pmod(deal, F.lit(blocks)).cast("long")), "block", ["id", "key", "label", "vec"]),
                   "negatives-blocks")
    asked = rows.filter("anchor").withColumn("part", F.pmod(deal, F.lit(groups)).cast("long"))

    def cells(anchors: DataFrame, columns: list[str], visit, schema: str) -> DataFrame:
        """``visit`` on every (block of anchors, block of rows); the stated query set meets all rows, block by block."""
        places = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
        grid = ["dim", "block", "part"]
        left = _packed(anchors, "part", columns).withColumn("block", places(blocks))

        def run(one: pa.Table, other: pa.Table) -> pa.Table:
            out = []
            if one.num_rows and other.num_rows:
                dim = one["dim"][0].as_py()
                mine, a = _unpacked(one, dim)
                theirs, b = _unpacked(other, dim)
                ids, labels = theirs["id"].to_numpy(), theirs["label"].to_numpy(zero_copy_only=False)
                for start in range(0, len(a), ANCHORS):
                    part = mine.slice(start, ANCHORS)
                    me = part["id"].to_numpy()
                    same = part["label"].to_numpy(zero_copy_only=False)[:, None] == labels
                    score = scores(a[start:start + ANCHORS], b)
                    score = score if score.dtype == np.int64 else np.clip(score, -LONG_MAX - 1, LONG_MAX)
                    out += visit(part, me, ids, same, me[:, None] != ids, score)
            names = [f.split()[0] for f in schema.split(", ")]
            return pa.table({c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(names)})

        return left.groupBy(*grid).cogroup(every.withColumn("part", places(groups)).groupBy(*grid)).applyInArrow(run, schema)

    def find_positives(part, me, ids, same, not_me, score):
        keys = part["key"].to_pylist()
        return [(int(me[i]), keys[i], int(ids[x]), int(score[i, x]))
                for i, at in enumerate(positives_of(score, same & not_me, positives)) for x in at]

    def find_negatives(part, me, ids, same, not_me, score):
        keys, own, own_ids = part["key"].to_pylist(), part["scores"].to_pylist(), part["ids"].to_pylist()
        return [(int(me[i]), keys[i], place, own_ids[i][place], own[i][place], int(ids[x]), int(score[i, x]))
                for i, lists in enumerate(negatives_of(score, ~same & not_me, own, low, high, negatives))
                for place, at in enumerate(lists) for x in at]

    best = Window.partitionBy("anchor_id", "key").orderBy(F.col("score").desc(), "positive_id")
    found = cells(asked, ["id", "key", "label", "vec"], find_positives, "anchor_id long, key long, positive_id long, score long")
    found = (found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
             .groupBy(F.col("anchor_id").alias("id"), "key").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("all"))
             .select("id", "key", F.col("all.positive_id").alias("ids"), F.col("all.score").alias("scores")))
    asked = stored(asked.join(found, ["id", "key"]), "negatives-anchors")
    best = Window.partitionBy("anchor_id", "key", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    out = cells(asked, ["id", "key", "label", "vec", "ids", "scores"], find_negatives,
                "anchor_id long, key long, place long, positive_id long, positive_score long, negative_id long, negative_score long")
    return (out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
