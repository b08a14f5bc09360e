"""Substring dedup over words: windows that repeat are found level by level.

Rows are dealt to chunks of a few megabytes of text, once; every level works
chunk by chunk on that same exchange. The first level takes short windows (a
sample of them that hits every window of the wanted length: of any run of
neighbouring short windows, the one with the smallest hash). A chunk sends
the distinct hashes of its windows to buckets of hashes, and gets back those
that occur elsewhere too. Only windows whose parts all repeat are extended to
twice the length, and so on up to the wanted length, at which the smallest id
of the documents that a window starts in comes back with it. A window that
many rows share goes out once a chunk, so no key is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.llm.common import (free_name, hashable, prepare, shuffle_partitions, span_hashes, spread_copies, text_bytes,
                                    windows, word_spans)

#: Bytes of text of a chunk, on average.
CHUNK_BYTES = 8 << 20
#: Bytes of hashes of a bucket, on average.
BUCKET_BYTES = 16 << 20
#: The first level's windows are not shorter than this, if the wanted ones aren't.
SHORTEST = 7

_U, _TOP = np.uint64, np.iinfo(np.int64).max


def levels(length: int) -> list[int]:
    """Window lengths from the first level on, each at most twice the one before."""
    out = [length]
    while -(-out[0] // 2) >= SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """best of x[i], ..., x[i + n - 1] for each i (fewer at the end)."""
    out, have = x.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[:len(out) - step] = best(out[:len(out) - step], out[step:])
        have += step
    return out


class Words:
    """The words of a chunk's texts, and their windows."""

    def __init__(self, column):
        self.raw, self.at_byte = text_bytes(column)
        self.starts, self.ends, self.at = word_spans(self.raw, self.at_byte)
        self.hashes = span_hashes(self.raw, self.starts, self.ends)
        self.text = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return windows(self.hashes, self.at, k)

    def anchors(self, k: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the windows of k words; which of them are anchors, as the least
        among those of some window of ``length`` words; and each such window's least."""
        h, _ = self.windows(k)
        whole = self.windows(length)[1]
        n = length - k + 1
        least = np.where(whole, _slide(h, n, np.minimum), _U(0))
        reach = _slide(least[::-1], n, np.maximum)[::-1]
        return h, (reach == h) & (reach > 0), least

    def candidates(self, length: int, before: int, known: np.ndarray, sampled: bool) -> np.ndarray:
        """Starts of the windows of ``length`` words whose parts of ``before``
        words are known to repeat: the least one if these were sampled, else
        the first and the last, which cover the window."""
        if not len(known):
            return np.zeros(0, np.int64)
        if sampled:
            _, _, least = self.anchors(before, length)
            return np.flatnonzero((least > 0) & _among(least, known))
        h, whole = self.windows(before)
        ok = whole & _among(h, known)
        last = np.zeros(len(ok), bool)
        shift = length - before
        last[:len(ok) - shift] = ok[shift:]
        return np.flatnonzero(self.windows(length)[1] & ok & last)


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of x are in ``known`` (sorted, not empty)."""
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal numbers (0 or more)."""
    cuts = np.flatnonzero(np.diff(x, prepend=-1)).tolist()
    return list(zip(cuts, [*cuts[1:], len(x)], strict=True)) if cuts else []


def _distinct(keys: list[np.ndarray], docs: np.ndarray | None = None):
    """Distinct keys (columns of uint64) in order; whether each occurs more than
    once (with other docs, if given); the least of its docs."""
    order = np.lexsort(([docs] if docs is not None else []) + keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(order))[:len(at)] - 1
    if docs is None:
        return [k[at] for k in keys], last > at, None
    docs = docs[order]
    return [k[at] for k in keys], docs[last] != docs[at], docs[at]


def _deal(chunk: int, keys: list[np.ndarray], several: np.ndarray, docs: np.ndarray | None, buckets: int) -> pa.Table:
    """One row a bucket with the keys that belong there."""
    bucket = (keys[0] % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    out: dict[str, list] = {"bucket": [], "chunk": [], "keys": [], "several": [], "docs": []}
    for low, high in _runs(bucket[order]):
        own = order[low:high]
        out["bucket"].append(int(bucket[own[0]]))
        out["chunk"].append(chunk)
        out["keys"].append(np.concatenate([k[own] for k in keys]).tobytes())
        out["several"].append(np.packbits(several[own]).tobytes())
        out["docs"].append(None if docs is None else docs[own].tobytes())
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(
        out.items(), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)})


_SENT = "bucket long, chunk long, keys binary, several binary, docs binary"
_BACK = "chunk long, keys binary, docs binary"


def _meet(width: int):
    """Reducer of a bucket: gives each chunk those of its keys that occur in
    another chunk or in several documents of its own. With docs, only those
    that occur in a document of a larger id than the least, and that id."""
    def run(group: pa.Table) -> pa.Table:
        chunks, keys, several, docs = [], [[] for _ in range(width)], [], []
        for c, k, s, d in zip(*(group[n].to_pylist() for n in ("chunk", "keys", "several", "docs")), strict=True):
            k = np.frombuffer(k, _U).reshape(width, -1)
            for i in range(width):
                keys[i].append(k[i])
            chunks.append(np.full(k.shape[1], c))
            several.append(np.unpackbits(np.frombuffer(s, np.uint8), count=k.shape[1]).astype(bool))
            if d is not None:
                docs.append(np.frombuffer(d, np.int64))
        chunk, several = np.concatenate(chunks), np.concatenate(several)
        keys = [np.concatenate(k) for k in keys]
        doc = np.concatenate(docs) if docs else None
        order = np.lexsort(keys[::-1])
        keys, chunk, several = [k[order] for k in keys], chunk[order], several[order]
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(order)))
        repeats = np.repeat((n > 1) | np.logical_or.reduceat(several, at), n)
        least = None
        if doc is not None:  # a chunk that holds only the first document need not hear of it
            first = np.repeat(np.minimum.reduceat(doc[order], at), n)
            repeats &= several | (doc[order] > first)
            least = np.where(several, first, np.iinfo(np.int64).min)[repeats]  # else any smaller id says the same
        keys, chunk = [k[repeats] for k in keys], chunk[repeats]
        by = np.argsort(chunk, kind="stable")
        out: dict[str, list] = {"chunk": [], "keys": [], "docs": []}
        for low, high in _runs(chunk[by]):
            own = by[low:high]
            out["chunk"].append(int(chunk[own[0]]))
            out["keys"].append(np.concatenate([k[own] for k in keys]).tobytes())
            out["docs"].append(None if least is None else least[own].tobytes())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(
            out.items(), (pa.int64(), pa.binary(), pa.binary()), strict=True)})
    return run


def _received(back: pa.Table, width: int) -> tuple[list[np.ndarray], np.ndarray | None]:
    """Keys (sorted) and docs that came back to a chunk."""
    keys = [np.concatenate([np.frombuffer(k, _U).reshape(width, -1)[i] for k in back["keys"].to_pylist()] or [np.zeros(0, _U)])
            for i in range(width)]
    docs = [np.frombuffer(d, np.int64) for d in back["docs"].to_pylist() if d is not None]
    order = np.lexsort(keys[::-1])
    return [k[order] for k in keys], np.concatenate(docs)[order] if docs else None


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 13, joined: bool = False,
                   chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with each word removed from ``text`` that a window of ``length``
    consecutive words covers whose words also start, in the same order, a
    window of a row with a smaller id; windows are those of the input.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. With ``joined``, the words
    that stay are joined by one space; otherwise the text stays as it is,
    without the removed words and the white space after each. n_words and
    n_removed are added (columns of those names are replaced). All rows and
    other columns stay. A null text has no words (it stays null unless
    ``joined``, which makes it empty). Rows with the same id are one document:
    none is smaller than the other; a null id is larger than any other.
    Windows are compared by 128-bit hashes.
    """
    spark = prepare(docs)
    docs = docs.drop(*(c for c in ("n_words", "n_removed") if c not in (id_col, text)))
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0))).first()[0]
    parts = shuffle_partitions(spark)
    chunks = max(-(-total // chunk_bytes), parts)
    buckets = max(-(-int(total * 0.36) // bucket_bytes), parts)  # 8 bytes for a fourth of the words
    chunk, nth = free_name(docs, "_chunk"), free_name(docs, "_nth")
    dealt = spread_copies(docs, nth).withColumn(chunk, F.pmod(F.xxhash64(*hashable(docs), nth), F.lit(chunks)).cast("long")).drop(nth)
    steps = levels(length)

    def send_first(group: pa.Table) -> pa.Table:
        w = Words(group[text])
        if len(steps) == 1:
            return send_last(w, group, np.flatnonzero(w.windows(length)[1]))
        h, chosen, _ = w.anchors(steps[0], steps[1])
        keys, several, _ = _distinct([h[chosen]])
        return _deal(group[chunk][0].as_py(), keys, several, None, buckets)

    def last_keys(w: Words, at: np.ndarray) -> list[np.ndarray]:
        other = windows(span_hashes(w.raw, w.starts, w.ends, 1), w.at, length, 1)[0]
        return [w.windows(length)[0][at], other[at]]

    def ids_of(group: pa.Table) -> np.ndarray:
        return group[id_col].combine_chunks().cast(pa.int64()).fill_null(_TOP).to_numpy()

    def send_last(w: Words, group: pa.Table, at: np.ndarray) -> pa.Table:
        keys, several, least = _distinct(last_keys(w, at), ids_of(group)[w.text[at]])
        return _deal(group[chunk][0].as_py(), keys, several, least, buckets)

    def send_next(i: int):
        def run(group: pa.Table, back: pa.Table) -> pa.Table:
            if not group.num_rows or not back.num_rows:
                return _deal(0, [np.zeros(0, _U)], np.zeros(0, bool), None, buckets)
            w = Words(group[text])
            at = w.candidates(steps[i], steps[i - 1], _received(back, 1)[0][0], sampled=i == 1)
            if i == len(steps) - 1:
                return send_last(w, group, at)
            keys, several, _ = _distinct([w.windows(steps[i])[0][at]])
            return _deal(group[chunk][0].as_py(), keys, several, None, buckets)
        return run

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    for f in schema.fields:
        if f.name == text:
            f.dataType, f.nullable = T.StringType(), True
    place = docs.columns.index(text)

    def cut(group: pa.Table, back: pa.Table) -> pa.Table:
        plain = group.drop_columns([chunk])
        if not group.num_rows:
            return plain.append_column("n_words", pa.array([], pa.int64())).append_column("n_removed", pa.array([], pa.int64()))
        w = Words(group[text])
        gone = np.zeros(len(w.hashes), bool)
        if back.num_rows:
            keys, least = _received(back, 2)
            at = np.flatnonzero(w.windows(length)[1])
            at = at[_among(w.windows(length)[0][at], keys[0])]
            mine = last_keys(w, at)
            found = np.searchsorted(keys[0], mine[0])
            if (keys[0][1:] == keys[0][:-1]).any():  # a 64-bit collision: look both halves up
                place_of = {k: i for i, k in enumerate(zip(*(k.tolist() for k in keys), strict=True))}
                found = np.array([place_of.get(k, 0) for k in zip(*(k.tolist() for k in mine), strict=True)], np.int64)
            hit = (keys[0][found] == mine[0]) & (keys[1][found] == mine[1]) & (least[found] < ids_of(group)[w.text[at]])
            edge = np.zeros(len(w.hashes) + 1, np.int32)
            np.add.at(edge, at[hit], 1)
            np.add.at(edge, at[hit] + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
        raw, texts = w.raw.tobytes(), []
        nulls = group[text].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.at])
        for i in range(group.num_rows):
            low, high = w.at[i], w.at[i + 1]
            whole = raw[w.at_byte[i]:w.at_byte[i + 1]]
            if not removed[i]:
                texts.append(b" ".join(whole.split()) if joined else None if nulls[i] else whole)
            elif joined:
                keep = low + np.flatnonzero(~gone[low:high])
                texts.append(b" ".join([raw[s:e] for s, e in zip(w.starts[keep].tolist(), w.ends[keep].tolist(), strict=True)]))
            else:  # from each run of words that stay: up to the next word's start
                edges = np.flatnonzero(np.diff(np.concatenate([[True], ~gone[low:high], [True]])))
                start, pieces = int(w.at_byte[i]), []
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    pieces.append(raw[start:w.starts[low + a]])
                    start = int(w.starts[low + b]) if low + b < high else int(w.at_byte[i + 1])
                texts.append(b"".join([*pieces, raw[start:w.at_byte[i + 1]]]))
        column = pa.array(texts, pa.binary()).cast(pa.string())
        return (plain.set_column(place, text, column).append_column("n_words", pa.array(np.diff(w.at)))
                .append_column("n_removed", pa.array(removed.astype(np.int64))))

    sent = dealt.groupBy(chunk).applyInArrow(send_first, _SENT)
    for i in range(1, len(steps)):
        back = sent.groupBy("bucket").applyInArrow(_meet(1), _BACK)
        sent = dealt.groupBy(chunk).cogroup(back.groupBy("chunk")).applyInArrow(send_next(i), _SENT)
    back = sent.groupBy("bucket").applyInArrow(_meet(2), _BACK)
    return dealt.groupBy(chunk).cogroup(back.groupBy("chunk")).applyInArrow(cut, schema)
