"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken target / size times, which is a
whole number of copies and a fraction. Fractions become 0 or 1 by pairing
documents: words move from one of the pair to the other, in a random
direction whose odds keep every document's expected share, until one of the
two is whole. The words taken from a source stay the same throughout. Blocks
of documents are rounded in parallel; what each leaves, one document with a
fraction and a few documents of each order of size, meets on the next level of
a tree, and at the source's root these last documents are rounded from the
largest on, each one's deviation spread over the smaller ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadscope.llm.common import free_name, mix, prepare, stored

#: Documents of a block on the lowest level, on average.
BLOCK_DOCS = 4096
#: Blocks that meet in one on the next level.
FAN_IN = 32
#: Documents of each order of size (powers of two) that a block leaves open for the levels above.
RESERVE = 8

WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) for ``sizes`` (source, source_size, n).

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``factor`` times all sizes; a target stops at ``most`` times its source's
    size, and what is over is shared by weight among the others until none is
    above. Each round is an aggregate that brings three numbers to the driver.
    Sources are numbered in order without gathering them: range-partitioned,
    numbered within the partition, and moved on by the rows before it.
    """
    part = F.spark_partition_id()
    ranged = sizes.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source")
    ranged = stored(ranged.withColumn("part", part), "mix-sources")
    numbered = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("last", "source")))
    counts = ranged.groupBy("part").agg(F.count("*").alias("rows"), F.min(F.struct("last", "source")).alias("first"))
    before = counts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    place = F.pmod(F.col("at") + F.col("before") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    rows = numbered.join(before, "part").select("source", "source_size", "n", weight.alias("weight"))
    rows = stored(rows, "mix-weights")
    cap = F.col("source_size") * float(most)
    total = float(rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * factor
    level, full = 0.0, -1
    while True:  # targets are min(cap, level * weight); the level rises as long as more sources are full
        capped = F.col("weight") * F.lit(level) >= cap
        taken, open_weight, n = rows.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(capped.cast("long")), F.lit(0))).first()
        if n == full or not open_weight:
            break
        full, level = n, max(0.0, total - taken) / open_weight
    target = F.least(cap, F.col("weight") * F.lit(level)).cast("double")
    return rows.select("source", "source_size", "n", target.alias("target"))


def _random(keys: np.ndarray, seed: int) -> np.ndarray:
    """Numbers from 0 to 1, given by the documents' keys."""
    return (mix(keys.astype(np.int64).view(np.uint64), seed) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivot(sizes: np.ndarray, shares: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Shares (0 to 1) after pairing: all 0 or 1 but for at most one. The words
    sum(sizes * shares) stay the same, and so does every share's expectation."""
    size, share, draw = sizes.tolist(), shares.tolist(), draws.tolist()
    held = -1
    for i in range(len(size)):
        if not 0.0 < share[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min(size[a] * (1 - share[a]), size[b] * share[b])  # words that a can take from b
        down = min(size[a] * share[a], size[b] * (1 - share[b]))
        words = up if draw[i] * (up + down) < down else -down
        share[a] += words / size[a]
        share[b] -= words / size[b]
        for x in (a, b):
            if share[x] < 1e-9 or share[x] > 1 - 1e-9:
                share[x] = float(round(share[x]))
        open_ones = [x for x in (a, b) if 0.0 < share[x] < 1.0]
        held = open_ones[0] if open_ones else -1
    return np.array(share)


def settle(sizes: np.ndarray, shares: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """All shares 0 or 1: from the largest document on, each is drawn by its
    share, and the words that this adds or takes are spread over the smaller
    ones; if they cannot hold them, it is rounded to the nearer side."""
    share = shares.astype(np.float64).copy()
    order = np.lexsort((draws, -sizes))
    for i, x in enumerate(order):
        if not 0.0 < share[x] < 1.0:
            continue
        rest = order[i + 1:]
        rest = rest[(share[rest] > 0) & (share[rest] < 1)]
        size, part = sizes[rest], share[rest]
        room = {1.0: float((size * part).sum()), 0.0: float((size * (1 - part)).sum())}  # words the rest can give, or take
        moved = {1.0: sizes[x] * (1 - share[x]), 0.0: sizes[x] * share[x]}
        to = 1.0 if draws[x] < share[x] else 0.0
        if moved[to] > room[to]:
            over = {t: max(0.0, moved[t] - room[t]) for t in (0.0, 1.0)}
            to = min((0.0, 1.0), key=lambda t: (over[t], t != to))
        words = min(moved[to], room[to])
        if len(rest) and room[to] > 0:
            share[rest] = part * (1 - words / room[to]) if to else part + (1 - part) * words / room[to]
        share[x] = to
    return np.clip(np.round(share), 0, 1)


def round_block(group: pd.DataFrame, n: int, reserve: int, seed: int) -> pd.DataFrame:
    """A block's open documents on level ``n``: those beyond ``reserve`` of an
    order of size are paired, on the lowest level of every source; at the root
    of the source (its only block) what is left is settled."""
    root = group["blocks"].iloc[0] <= 1
    group = group.sort_values(["size", "key"], kind="stable", ignore_index=True)
    draws = _random(group["key"].to_numpy() + np.arange(len(group)), seed)
    size, share = group["size"].to_numpy(np.float64), group["share"].to_numpy(np.float64, copy=True)
    order = np.floor(np.log2(size)).astype(np.int64)  # sizes ascend
    paired = np.arange(len(order)) - np.searchsorted(order, order) >= reserve
    if n == 0 or not root:
        share[paired] = pivot(size[paired], share[paired], draws[paired])
    if root:
        share = settle(size, share, draws)
    group["share"], group["open"] = share, (share > 0) & (share < 1)
    return group


def _level(n: int, fan_in: int, reserve: int, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = round_block(group, n, reserve, seed)
        group["block"] //= fan_in
        group["blocks"] = -(-group["blocks"] // fan_in)
        return group
    return run


def copies(rows: DataFrame, block_docs: int = BLOCK_DOCS, fan_in: int = FAN_IN, reserve: int = RESERVE,
           seed: int = 11) -> DataFrame:
    """``rows`` (source, key, size, n: documents of the source, times: copies
    wanted) with copies: a whole number, times rounded down or up."""
    prepare(rows)
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    schema = ", ".join([*kept, "share double", "blocks long", "block long", "open boolean"])
    share = F.col("times") - F.floor("times")
    blocks = F.ceil(F.col("n") / block_docs)
    state = rows.withColumns({
        "share": F.when(F.col("size") > 0, share).otherwise(F.lit(0.0)), "blocks": blocks,
        "block": F.pmod(F.xxhash64("key", F.lit(seed)), blocks)}).withColumn(
        "open", (F.col("share") > 0) & (F.col("share") < 1)).select(*rows.columns, "share", "blocks", "block", "open")
    most = rows.agg(F.coalesce(F.max(blocks), F.lit(1))).first()[0]

    done, n = [state.filter("not open")], 0
    state = state.filter("open")
    while True:
        last = most <= 1
        out = stored(state.groupBy("source", "block").applyInPandas(_level(n, fan_in, reserve, seed + n), schema), f"mix-level{n}")
        done.append(out.filter("not open"))
        state, most, n = out.filter("open"), -(-most // fan_in), n + 1
        if last:
            break
    every = done[0]
    for d in done[1:]:
        every = every.union(d)
    return every.select(*rows.columns, (F.floor("times") + F.col("share")).cast("long").alias("copies"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
                weights: tuple[float, ...] = WEIGHTS, factor: float = 1.5, most: float = 2.0, seed: int = 11,
                **tree) -> DataFrame:
    """``docs`` with size (words), source_size, target (words, of its source) and
    copies: how often the mix takes the document, 0 to ``most`` rounded up.

    Copies depend on id, source and text alone, so reruns agree; rows alike in
    all three share their copies as evenly as can be. Null sources are one
    source, after all others. Documents without words (null and empty texts)
    are taken 0 times, and so is everything where no document has words.
    Columns of the added names are replaced; all rows and other columns stay.
    """
    names = ["size", "source_size", "target", "copies"]
    docs = docs.drop(*(c for c in names if c not in (id_col, source, text)))
    key, same = free_name(docs, "_key"), free_name(docs, "_same")
    who = [F.col(f"`{c}`") for c in (id_col, source, text)]
    docs = docs.withColumns({key: F.xxhash64(*who, F.col(f"`{id_col}`").isNull(), F.col(f"`{source}`").isNull()),
                             "size": word_count(text)})
    narrow = stored(docs.select(F.col(f"`{source}`").cast("string").alias("source"), F.col(key).alias("key"), "size"), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = stored(source_targets(sizes, weights, factor, most), "mix-targets")
    s = F.col("t.source")
    rows = (narrow.alias("d").join(targets.hint("merge").alias("t"), F.col("d.source").eqNullSafe(s))
            .select("d.source", "d.key", "d.size", "t.n", "t.source_size", "t.target",
                    F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0).alias("times")))
    taken = copies(rows, seed=seed, **tree)
    # Rows alike share a key: their copies are summed and dealt out again, one more to the first of them.
    of = free_name(docs, "_of")
    per_key = taken.groupBy(F.col("key").alias(key)).agg(
        F.sum("copies").alias("n"), F.count("*").alias("alike"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    out = docs.join(per_key.select(key, F.struct("n", "alike", "source_size", "target").alias(of)).hint("merge"), key)
    n, alike = F.col(of)["n"], F.col(of)["alike"]
    out = out.withColumn(same, F.when(alike > 1, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1)))).otherwise(1))
    count = F.floor(n / alike) + (F.col(same) <= F.pmod(n, alike)).cast("long")
    return out.withColumns({"source_size": F.col(of)["source_size"], "target": F.col(of)["target"],
                            "copies": F.when(F.col("size") > 0, count).otherwise(0).cast("long")}).drop(key, same, of)
