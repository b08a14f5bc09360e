"""Helpers that the operators of this subpackage share: scratch tables in the
cluster's shared folder, hashing of words and word windows in numpy, and
connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadscope.session import scratch_path, ship_package

#: Bytes that end a word ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes of text that are hashed at a time (working memory is about 40 times that).
BLOCK = 1 << 18


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that the cluster names."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once: written to the shared folder and read back. Cuts
    the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(df: DataFrame) -> SparkSession:
    """The session of ``df``, whose Python workers can import this package."""
    spark = df.sparkSession
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front of it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hashable(df: DataFrame) -> list:
    """Columns that xxhash64 takes (it takes no maps and no variants)."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields
            if not any(t in f.dataType.simpleString() for t in ("map<", "variant", "interval"))]


def spread_copies(df: DataFrame, name: str, block: int = 1024) -> DataFrame:
    """``df`` with a long column ``name`` by which rows that are alike in all
    columns can be dealt out: they share a number by at most ``block``.

    Rows alike are interchangeable. Those with more than ``block`` copies are
    counted, map-side first, and made again from one of them, block by block;
    all others have the number 0. Nothing depends on partitions. Tables with
    columns that cannot be grouped, or hold floating-point numbers (of which
    equal ones may differ in bits), keep their rows as they are, numbered 0."""
    kinds = df.schema.simpleString()
    if len(hashable(df)) < len(df.columns) or "float" in kinds or "double" in kinds:
        return df.withColumn(name, F.lit(0).cast("long"))
    spark = df.sparkSession
    a, b, n = (free_name(df, x) for x in ("_hash_a", "_hash_b", "_copies"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumns({a: F.xxhash64(*columns), b: F.xxhash64(F.lit(1), *columns)})
    often = stored(keyed.groupBy(a, b).agg(F.count("*").alias(n)).filter(F.col(n) > block).select(a, b), "copies")
    if often.isEmpty():
        return df.withColumn(name, F.lit(0).cast("long"))
    few = keyed.join(often, [a, b], "left_anti").select(*columns, F.lit(0).cast("long").alias(name))
    groups = keyed.join(often, [a, b], "left_semi").groupBy(*columns).agg(F.count("*").alias(n))
    blocks = groups.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / block))))
    blocks = blocks.repartition(shuffle_partitions(spark), F.xxhash64(*columns), name)
    again = blocks.withColumn(a, F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(block), F.col(n) - F.col(name) * block))))
    return few.unionByName(again.select(*columns, name))


# --- words and windows in numpy -------------------------------------------

_U = np.uint64
#: Odd multiplier of the polynomial hashes, and its inverse modulo 2**64.
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser of splitmix64: every bit of the input changes every bit."""
    x = x + _U((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the multiplier and of its inverse."""
    if len(_powers.get("up", ())) <= n:
        m = max(n + 1, BLOCK + 4096)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(m, base, _U)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U), seed + 17)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_spans(raw: np.ndarray, at: np.ndarray, ends_word: np.ndarray = SPACES
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and n + 1 offsets of the texts' words."""
    if not len(raw):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(at), np.int64)
    inside = ~ends_word[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside
    last = inside & np.append(~inside[1:] | edge[1:-1], True)
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans that lie in ascending order (they may not
    overlap): differences of a polynomial prefix hash, taken block by block."""
    out = np.empty(len(starts), _U)
    byte = _byte_table(seed)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = _tables(high - low)
        prefix = np.zeros(high - low + 1, _U)
        np.cumsum(byte[raw[low:high]] * up[:high - low], out=prefix[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (prefix[e] - prefix[s]) * down[s] + (e - s).astype(_U)
        i = j
    return mix(out, seed)


def windows(words: np.ndarray, at: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether the window stays
    within its text. ``words``: hashes, ``at``: n + 1 offsets of the texts."""
    n = len(words)
    if n < k:
        return np.zeros(n, _U), np.zeros(n, bool)
    out = np.zeros(n, _U)
    for low in range(0, n - k + 1, BLOCK):
        m = min(BLOCK, n - k + 1 - low)
        up, down = _tables(m + k)
        prefix = np.zeros(m + k, _U)
        np.cumsum(words[low:low + m + k - 1] * up[:m + k - 1], out=prefix[1:])
        out[low:low + m] = (prefix[k:k + m] - prefix[:m]) * down[:m]
    whole = np.zeros(n + 1, np.int32)
    starts, ends = at[:-1], np.maximum(at[:-1], at[1:] - k + 1)
    np.add.at(whole, starts, 1)
    np.add.at(whole, ends, -1)
    return mix(out, seed + k), np.cumsum(whole[:-1]) > 0


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows, of about ``most`` bytes of text."""
    if not batch.num_rows:
        return
    _, at = text_bytes(batch.column(batch.schema.get_field_index(text)))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


# --- connected components ---------------------------------------------------

def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` is linked
    to, directly or over others. Undirected; loops and repeats may occur.

    Alternates large-star and small-star steps: each links a node's larger
    neighbours, then its smaller ones, with the smallest. Every step groups
    by node with map-side partial minima and joins the minimum back (AQE
    splits the rows of a hot node); edges are written to the shared folder
    after each step. Ends when a round changes no edge.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = stored(e, "edges")
    before = None
    while True:
        # Large-star: v > u gets the minimum over u's neighbours and u.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "edges")  # read three times below: a short plan
        # Small-star: u's smaller neighbours, and u itself, get the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))).distinct()
        e = stored(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if before is not None and tuple(now) == tuple(before):
            break
        before = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.union(roots)


# --- integer vectors ----------------------------------------------------------

def integer_rows(df: DataFrame, vector: str, scale: float, **kept) -> DataFrame:
    """The columns ``kept`` of the rows whose vector is not null and holds finite
    components only, vec (floor(scale * x) of each component x as a double,
    clamped to the long range) and dim (their number)."""
    x = F.col(f"`{vector}`").cast("array<double>")
    odd = F.coalesce(F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True))
    return df.filter(F.col(f"`{vector}`").isNotNull() & ~odd).select(
        *(c.alias(name) for name, c in kept.items()),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("vec"), F.size(x).alias("dim"))


def list_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls, all of ``dim`` entries, as a matrix."""
    return column.flatten().to_numpy().reshape(len(column), dim)
