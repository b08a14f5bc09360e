"""Best-fit packing of token sequences after a dominance reduction.

Documents are tokenized in one pass and cut into pieces no longer than a
sequence. What is packed is the histogram of the pieces' lengths: one row a
length, so as many rows as a sequence has tokens, however many pieces there
are. The reduction of Martello and Toth takes lengths, the longest first, and
permanently fixes a set of at most three that dominates every other set with
that length, until none is left; the rest goes best-fit from the longest on.
Both work on many equal sequences at a time. Pieces are then numbered within
their length, and their number says which place they take.
"""

from __future__ import annotations

import os
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.llm.common import prepare, slices, span_hashes, stored, text_bytes

#: Words whose ids a worker remembers.
REMEMBERED = 500_000
#: Words that are encoded as one text.
JOINED = 512

# How the tokenizer divides ASCII text and the Latin-1 letters,
# which normalisation leaves single letters. Classes of bytes: white space,
# parts of a letter, digits (each a word of its own), and others.
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_CLASS = np.full(256, _SIGN, np.int8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = _LETTER
_CLASS[[*range(0x30, 0x3A)]] = _DIGIT
#: After an apostrophe that begins a word, these letters end it.
_ONE, _TWO = b"stmd", (b"re", b"ve", b"ll")
#: What the last token of a word ends with.
_END = "</w>"


# --- tokens ------------------------------------------------------------------

def split_words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with small ASCII letters, and start and end byte of each word, of
    texts with the n + 1 offsets ``at``.

    No rule of the tokenizer looks across white space, which it drops, so texts
    fall into parts between ASCII white space. A part of ASCII and Latin-1
    letters is divided as the tokenizer does it; a part with any other character
    (or a multiplication or division sign, or what a special token starts with)
    is one word, its letters as they are."""
    n = len(raw)
    kind = _CLASS[raw]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    inside = kind != _SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    follows = np.append(raw[1:], 0)
    odd = (raw == 0xC2) | (raw >= 0xC4) | (raw == 0xC3) & ((follows == 0x97) | (follows == 0xB7)) | (raw == 0x3C) & (follows == 0x7C)
    part = np.cumsum(first) - 1  # of a byte inside a part
    whole = np.zeros(int(first.sum()), bool)
    whole[part[odd]] = True
    simple = inside.copy()
    simple[inside] = ~whole[part[inside]]
    small = raw.copy()
    small[simple & (raw >= 0x41) & (raw <= 0x5A)] += 0x20
    begins = simple & (kind == _DIGIT)
    begins[1:] |= simple[1:] & (kind[1:] != kind[:-1])
    begins |= first
    mark = np.flatnonzero(begins & simple & (raw == 0x27))
    for letters in (*(bytes([c]) for c in _ONE), *_TWO):
        here = mark[mark + len(letters) < n]
        for i, c in enumerate(letters):
            here = here[(small[here + 1 + i] == c) & ~edge[here + 1 + i]]
        begins[here + 1] = False
        after = here + 1 + len(letters)
        after = after[after < n]
        begins[after[simple[after]]] = True
    stop = np.flatnonzero(np.append(begins | ~inside, True) | edge)
    starts = np.flatnonzero(begins)
    return small, starts, stop[np.searchsorted(stop, starts) + 1]


class Words:
    """Token ids of texts, each distinct word encoded once; words are told apart
    by 64-bit hashes among those that are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(_END)]] = True
        self.forget()

    def forget(self) -> None:
        self.known, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids, sizes = [self.flat], []
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for group, found in zip(groups, self._encode([b" ".join(g) for g in groups]), strict=True):
            last = np.flatnonzero(self.ends[found])
            if len(last) == len(group):  # one end for each word
                ids.append(found)
                sizes.append(np.diff(last, prepend=-1))
            else:
                each = self._encode(group)
                ids += each
                sizes.append([len(e) for e in each])
        size = np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate(ids)
        known, start, size = (np.concatenate(x) for x in ((self.known, hashes), (self.start, start), (self.size, size)))
        order = np.argsort(known)
        self.known, self.start, self.size = known[order], start[order], size[order]

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the n + 1 offsets of the texts."""
        if len(self.known) > REMEMBERED:
            self.forget()
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        small, starts, ends = split_words(raw, at)
        hashes, first, place = np.unique(span_hashes(small, starts, ends), return_index=True, return_inverse=True)
        new = ~np.isin(hashes, self.known, assume_unique=True)
        if new.any():
            self._learn(hashes[new], [small[a:b].tobytes() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
        found = np.searchsorted(self.known, hashes)
        start, n = self.start[found][place], self.size[found][place]
        total = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(start - total[:-1], n) + np.arange(total[-1])
        return self.flat[take], total[np.searchsorted(starts, at)]


_words: dict[str, Words] = {}


def cut_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = 2048,
               end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, nth): the tokens of every row's
    text (null: none) and ``end_id``, in pieces of ``capacity`` tokens, the last
    one shorter. ids holds the tokens as little-endian unsigned 32-bit numbers.
    part and nth number the pieces of one length within a task."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                       F.spark_partition_id().alias("part"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())])

    def run(batches):
        words = _words.get(tokenizer) or _words.setdefault(tokenizer, Words(tokenizer))
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, at = words.encode(*text_bytes(rows.column(1)))
                sizes = np.diff(at) + 1
                at = np.concatenate([[0], np.cumsum(sizes)])
                every = np.full(int(at[-1]), end_id, "<u4")
                inside = np.ones(len(every), bool)
                inside[at[1:] - 1] = False
                every[inside] = ids
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                # The n-th of its length: those before it in this batch, and in the batches before.
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                cut = 4 * np.append(at[row] + start, at[-1])
                blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(every)])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                     blob.cast(pa.binary()), rows.column(2).take(pa.array(row)), pa.array(nth)], schema.names)

    return rows.mapInArrow(run, schema)


# --- packing lengths ----------------------------------------------------------

def dominating(counts: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """At most two lengths that, with a piece of length ``j``, dominate every
    other set with it that fits into a sequence; None if that cannot be told.

    A set dominates another if the other's pieces can be dealt to groups each of
    which fits into the place of one piece of the set: then whatever sequence
    the others are in can take the set's pieces instead."""
    rest = counts.copy()
    rest[j] -= 1
    there = np.flatnonzero(rest)
    there = there[there > 0]
    room = capacity - j
    if not len(there) or there[0] > room:
        return ()
    below = np.maximum.accumulate(np.where(rest > 0, np.arange(len(rest)), 0))  # the longest not above a length
    k = int(below[room])
    least = np.repeat(there[:3], np.minimum(rest[there[:3]], 3))[:3]
    if k == room or len(least) < 2 or least[:2].sum() > room:
        return (k,)  # it fills the sequence, or no two pieces fit beside j
    if len(least) > 2 and least.sum() <= room:
        return None
    y = there[there <= room // 2]
    x = below[room - y]
    fits = (x > y) | ((x == y) & (rest[y] > 1))
    y, x = y[fits], x[fits]
    if (x + y <= k).all():
        return (k,)
    rest[k] -= 1
    second = int(np.maximum.accumulate(np.where(rest > 0, np.arange(len(rest)), 0))[room - k])
    if second and ((y <= second) | (x + y <= k)).all():
        return (k, second)
    return None


def reduce(counts: np.ndarray, capacity: int) -> tuple[list[tuple[int, tuple[int, ...]]], np.ndarray]:
    """(times, lengths) of the sets that dominate, and the counts that are left.
    A set stays dominating while its pieces last, as fewer sets compete with it."""
    counts, fixed, more = counts.copy(), [], True
    while more:
        more = False
        for j in np.flatnonzero(counts)[::-1].tolist():
            while counts[j] and (others := dominating(counts, j, capacity)) is not None:
                lengths, each = np.unique([j, *others], return_counts=True)
                times = int((counts[lengths] // each).min())
                counts[lengths] -= times * each
                fixed.append((times, (j, *others)))
                more = True
    return fixed, counts


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) of sequences filled from the longest piece on, each piece
    going where it leaves the least room. Equal sequences are filled together."""
    open_ones: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # by room
    for length in np.flatnonzero(counts)[::-1].tolist():
        n, room = int(counts[length]), length
        while n:
            while room <= capacity and not open_ones.get(room):
                room += 1
            times, inside = open_ones[room].pop() if room <= capacity else (n, ())
            left = min(room, capacity)
            fit = left // length
            full = min(times, n // fit)
            if full:
                open_ones[left - fit * length].append((full, (*inside, *[length] * fit)))
                n -= full * fit
            if full < times and n:  # fewer than one sequence takes
                open_ones[left - n * length].append((1, (*inside, *[length] * n)))
                full, n = full + 1, 0
            if full < times and inside:
                open_ones[room].append((times - full, inside))
    return [x for some in open_ones.values() for x in some]


def places(sequences: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows (length, number, sequence, offset, times), by length and number: from
    this number on, ``times`` pieces of the length lie at ``offset`` of
    ``sequence`` and of those after it, one in each."""
    out, number, first = [], defaultdict(int), 0
    for times, lengths in sequences:
        offset = 0
        for length in lengths:
            out.append((length, number[length], first, offset, times))
            number[length] += times
            offset += length
        first += times
    return np.array(sorted(out), np.int64).reshape(len(out), 5)


# --- documents ----------------------------------------------------------------

def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = 2048,
                   end_id: int = 0, with_ids: bool = True, extra=()) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece of
    every row's tokens (see ``cut_pieces``) and its place.

    Sequences are numbered from 0, and the pieces of one lie side by side from
    its offset 0 on. A null or empty text is one piece, ``end_id``; repeated
    rows are documents of their own; ids may be null. An empty table gives no
    rows. Other columns are not read. ``with_ids``: whether the tokens come
    along; ``extra``: (name, column) pairs to compute from the pieces before.
    """
    prepare(docs)
    pieces = stored(cut_pieces(docs, tokenizer, id_col, text, capacity, end_id), "pack-pieces")
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    lengths = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length
        lengths[r.length] = r.n
    fixed, rest = reduce(lengths, capacity)
    table = places([*fixed, *best_fit(rest, capacity)])
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    earlier = Window.partitionBy("length").orderBy("part")  # one row a task
    before = counts.select("length", "part", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    names = ["doc_id", "piece", "start", "length", *["ids"] * with_ids, *(name for name, _ in extra)]
    numbered = (pieces.withColumns(dict(extra)).select(*names, "part", "nth").join(before, ["length", "part"])
                .withColumn("nth", F.col("nth") + F.col("before")).select(*names, "nth"))
    schema = T.StructType([*numbered.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            length, nth = batch.column(3).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            at = np.empty(len(length), np.int64)
            for value in np.unique(length):
                own = length == value
                low, high = first[value], first[value + 1]
                at[own] = low + np.searchsorted(table[low:high, 1], nth[own], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(table[at, 2] + nth - table[at, 1]), pa.array(table[at, 3])], schema.names)

    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences, each put together from
    its pieces in the order of their offsets."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return parts.select("sequence_id", "length", whole.alias("ids"))
