"""Sharding by a two-pass external shuffle.

Pass one scatters all rows uniformly, by a seeded hash, into buckets of a
size that fits into memory. Pass two orders each bucket by the hash,
Fisher-Yates-shuffles it with a generator seeded by the bucket, and numbers
its rows on from the rows of all buckets before it. The numbers are a
permutation of all rows; shards are consecutive runs of it, so each bucket is
written to one shard or a few.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.llm.common import free_name, hashable, prepare, spread_copies

#: Bytes of text that a bucket holds on average, and buckets at least (as far as there are rows).
BUCKET_BYTES, BUCKETS = 16 << 20, 64


def row_bytes(text: str):
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(8)


def fisher_yates(n: int, *seed: int) -> np.ndarray:
    """A permutation of 0 to n - 1, drawn by swapping each place, from the last
    on, with a random place not after it."""
    rng = np.random.Generator(np.random.PCG64(list(seed)))
    swap = rng.integers(0, np.arange(n, 0, -1))  # for the places n - 1, n - 2, ..., 0
    order = list(range(n))
    for place, other in zip(range(n - 1, 0, -1), swap.tolist(), strict=False):
        order[place], order[other] = order[other], order[place]
    return np.array(order, np.int64)


def shuffle_shards(docs: DataFrame, shards: int = 24, seed: int = 20240607, text: str = "text",
                   bucket_bytes: int = BUCKET_BYTES, extra=()) -> DataFrame:
    """All rows and columns of ``docs`` (a repeated row stays repeated, null
    texts and ids too), with ``shard`` (0 to shards - 1; counts are at most one
    apart) and ``slot`` (the row's place in its shard, gapless from 0).

    Columns of ``docs`` that are named shard or slot are replaced. An empty
    table gives an empty one. Rows that are alike in all columns count as
    interchangeable, so the result is the same on every run, whatever the
    session's settings; where very many are alike they go into several buckets
    (see ``spread_copies`` for the tables that allow it). ``extra``:
    further (name, column) pairs to compute before the rows are dealt.
    """
    prepare(docs)
    docs = docs.drop("shard", "slot").withColumns(dict(extra))
    if not docs.columns:
        raise ValueError("a table without columns cannot be sharded")
    total = docs.agg(F.coalesce(F.sum(row_bytes(text)), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    buckets = max(-(-total.b // bucket_bytes), min(total.n, BUCKETS), 1)
    h, bucket, before, nth = (free_name(docs, x) for x in ("_hash", "_bucket", "_before", "_nth"))
    rows = (spread_copies(docs, nth).withColumn(h, F.xxhash64(F.lit(seed), *hashable(docs), nth)).drop(nth)
            .withColumn(bucket, F.pmod(F.col(h), F.lit(buckets)).cast("long")))
    # One row a bucket; their running count is the only thing that is ordered as a whole.
    counts = rows.groupBy(bucket).agg(F.count("*").alias("n"))
    offsets = counts.select(F.col(bucket).alias("bucket"), (F.sum("n").over(Window.orderBy(bucket)) - F.col("n")).alias(before))
    base, longer = divmod(total.n, shards)
    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()),
                           T.StructField("slot", T.LongType())])

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.drop_columns([h, bucket]).append_column(
                "shard", pa.array([], pa.int32())).append_column("slot", pa.array([], pa.int64()))
        left = left.take(pa.array(np.argsort(left[h].to_numpy(), kind="stable")))
        left = left.take(pa.array(fisher_yates(left.num_rows, seed, left[bucket][0].as_py())))
        place = np.arange(left.num_rows) + right[before][0].as_py()
        cut = longer * (base + 1)  # the first shards hold one row more
        shard = np.where(place < cut, place // (base + 1), longer + (place - cut) // max(base, 1))
        slot = np.where(place < cut, place % (base + 1), (place - cut) % max(base, 1))
        return (left.drop_columns([h, bucket]).append_column("shard", pa.array(shard.astype(np.int32)))
                .append_column("slot", pa.array(slot.astype(np.int64))))

    return (rows.groupBy(bucket).cogroup(offsets.groupBy("bucket")).applyInArrow(deal, schema))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder ``shard=N`` for each shard. As shards are runs of whole
    buckets, a task writes to one of them, or to a few; readers order a
    shard's rows by slot."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
