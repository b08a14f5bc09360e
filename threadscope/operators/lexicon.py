"""Word lists too long for one regular expression.

A list of thousands of words is a table. Spark hashes its words where they are;
their hashes, 16 bytes a word, go to every task. A task hashes, for each length
that a word has, the window that begins at each byte of its texts, and looks
them up all at once. Texts so stay where they are: nothing is shuffled, and a
task holds the hits of a piece of its texts only. The hits of a text are then
resolved from left to right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.operators.keywords import token_pattern
from threadscope.operators.relational import like_any
from threadscope.session import ship_package

#: Bytes of text whose windows are hashed at a time, and that are resolved at a time.
BLOCK, PIECE = 1 << 16, 1 << 20
_WILD = r"[%_\\]"
_RUN = re.compile("[A-Za-z0-9]{2}")

_U = np.uint64
#: Odd multipliers of the polynomial hashes modulo 2**64, and the hash of each byte.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, (2, 256), dtype=_U)
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers 0 to n - 1 of each multiplier and of its inverse."""
    if not _powers or len(_powers[0][0]) < n:
        made = []
        for base in _BASES:
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(max(n, 2 * BLOCK), b, _U)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            made.append(tuple(both))
        _powers[:] = made
    return _powers


def _prefixes(raw: np.ndarray) -> list[np.ndarray]:
    """For both hashes, the sums up to each byte."""
    return [np.append(_U(0), np.cumsum(_BYTES[i][raw] * up[:len(raw)])) for i, (up, _) in enumerate(_tables(len(raw)))]


def _text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty), ASCII letters in lower case if asked, and n + 1 offsets."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    if lower:
        raw = np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint8(32), raw)
    return raw, at - at[0]


def _pieces(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows, of about ``PIECE`` bytes of text."""
    _, at = _text_bytes(batch.column(place))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + PIECE, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def word_table(words: DataFrame, word: str = "word") -> DataFrame:
    """The distinct words that are not null or empty."""
    return words.select(F.col(word).cast("string").alias("word")).filter("word <> ''").distinct()


def word_hashes(words: DataFrame, lower: bool = False) -> Broadcast:
    """For each length in bytes of the words (``word_table``), ascending: both
    hashes of each word of it, sorted. 16 bytes a word pass the driver."""
    ship_package(words.sparkSession)

    def run(batches):
        for batch in batches:
            for part in _pieces(batch, 0):
                raw, at = _text_bytes(part.column(0), lower)
                found = [(sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]]
                         for sums, (_, down) in zip(_prefixes(raw), _tables(len(raw) + 1), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(at)), *(pa.array(f.view(np.int64)) for f in found)], ["n", "a", "b"])

    got = words.select("word").mapInArrow(run, "n long, a long, b long").toArrow()
    n, a, b = (got[c].to_numpy() for c in ("n", "a", "b"))
    a, b = a.view(_U), b.view(_U)
    lists = []
    for length in np.unique(n).tolist():
        mine = np.flatnonzero(n == length)
        mine = mine[np.lexsort((b[mine], a[mine]))]
        lists.append((length, a[mine], b[mine]))
    return words.sparkSession.sparkContext.broadcast(lists)


def _bitmaps(lists: list) -> list[tuple]:
    """With each length: a bitmap of its words' first bits, which rules most windows out, and the number of other bits."""
    out = []
    for length, a, b in lists:
        bits = min(22, max(10, int(16 * len(a)).bit_length()))
        seen = np.zeros(1 << bits, bool)
        seen[(a >> _U(64 - bits)).view(np.int64)] = True
        out.append((length, a, b, seen, _U(64 - bits)))
    return out


def hits(raw: np.ndarray, at: np.ndarray, lists: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) in bytes of every occurrence of a word in the texts, in
    no order. ``lists``: as ``_bitmaps`` makes them."""
    longest = lists[-1][0] if lists else 0
    starts, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(raw) if lists else 0, BLOCK):
        part = raw[low:low + BLOCK + longest - 1]
        one, two = _prefixes(part)
        (_, down), (_, down_two) = _tables(len(part))
        for length, a, b, seen, shift in lists:
            n = min(BLOCK, len(part) - length + 1)
            if n < 1:
                break
            key = (one[length:length + n] - one[:n]) * down[:n]
            i = np.flatnonzero(seen[(key >> shift).view(np.int64)])
            place = np.minimum(np.searchsorted(a, key[i]), len(a) - 1)
            ok = a[place] == key[i]
            i, place = i[ok], place[ok]
            i = i[b[place] == (two[i + length] - two[i]) * down_two[i]]
            starts.append(i + low)
            lengths.append(np.full(len(i), length))
    start, length = np.concatenate(starts), np.concatenate(lengths)
    within = start + length <= at[np.searchsorted(at, start, "right")] if len(start) else np.zeros(0, bool)
    return start[within], length[within]


_REST = re.compile(re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\u" + m[1].zfill(4), token_pattern([])))


def resolve(text: str, at: list[int], n: list[int]) -> list[str]:
    """Tokens of a text, from the longest words at its 0-based places, ascending."""
    tokens, free = [], 0
    for start, length in zip(at, n, strict=True):
        # A run of ASCII letters and digits is one token: inside it no word begins, unless one has just ended there.
        if start < free or start > free and _RUN.match(text, start - 1, start + 1):
            continue
        tokens += _REST.findall(text, free, start)
        tokens.append(text[start:start + length])
        free = start + length
    return tokens + _REST.findall(text, free)


def _tokens(column: pa.Array, lists: list[tuple]) -> list[list[str]]:
    """The tokens of each text."""
    raw, at = _text_bytes(column)
    start, length = hits(raw, at, lists)
    order = np.lexsort((-length, start))
    start, length = start[order], length[order]
    longest = np.append(True, start[1:] != start[:-1])[:len(start)]
    start, length = start[longest], length[longest]
    # Inside a run of ASCII letters and digits a word counts only where another one ends.
    digit, letter = (raw >= 0x30) & (raw <= 0x39), ((raw | 0x20) >= 0x61) & ((raw | 0x20) <= 0x7A)
    plain = digit | letter
    ends = np.zeros(len(raw) + 1, bool)
    ends[start + length] = True
    begins = ~plain
    begins[1:] |= ~plain[:-1]
    begins[at[:-1][at[:-1] < len(raw)]] = True
    kept = begins[start] | ends[start]
    start, length = start[kept], length[kept]
    chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))  # characters before each byte
    rows = np.searchsorted(start, at)
    first, n = chars[start] - np.repeat(chars[at[:-1]], np.diff(rows)), chars[start + length] - chars[start]
    first, n = first.tolist(), n.tolist()
    return [resolve(t or "", first[i:j], n[i:j]) for t, i, j in zip(column.to_pylist(), rows[:-1].tolist(), rows[1:].tolist(), strict=True)]


def segment_long(texts: DataFrame, words: DataFrame, text: str, key: str, out: str = "tokens") -> DataFrame:
    """``texts`` with the tokens that ``keywords.segment`` finds, for a lexicon of
    any length, given as a table with a column ``word``: at every position the
    longest word, else a run of ASCII letters and digits, else one character that
    is no white space. A null text has no tokens. ``key`` names the rows' key;
    rows stay whole, so it need not be unique."""
    held = word_hashes(word_table(words))
    texts = texts.drop(out)
    place = texts.columns.index(text)
    schema = T.StructType([*texts.schema.fields, T.StructField(out, T.ArrayType(T.StringType()))])

    def run(batches):
        lists = _bitmaps(held.value)
        for batch in batches:
            for part in _pieces(batch, place):
                tokens = _tokens(part.column(place).cast(pa.string()), lists)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(tokens, pa.list_(pa.string()))], schema.names)

    return texts.mapInArrow(run, schema)


def match_long(texts: DataFrame, keywords: DataFrame, text: str, key: str) -> DataFrame:
    """The rows of ``texts`` whose text contains a keyword (column ``word``), by
    the rules of ``relational.like_any``: ASCII case does not count. Keywords with
    LIKE's wildcards are matched as patterns; there should be few of those, they
    come to the driver. ``key`` names the rows' key; rows stay whole, so it need
    not be unique."""
    words = word_table(keywords)
    held = word_hashes(words.filter(~F.col("word").rlike(_WILD)), lower=True)
    wild = [r.word for r in words.filter(F.col("word").rlike(_WILD)).collect()]
    schema, place = texts.schema, texts.columns.index(text)
    odd = "_wild"
    while odd in texts.columns:
        odd = "_" + odd
    rows = texts.withColumn(odd, F.coalesce(like_any(F.col(text), wild), F.lit(False)) if wild else F.lit(False))

    def run(batches):
        lists = _bitmaps(held.value)
        for batch in batches:
            for part in _pieces(batch, place):
                raw, at = _text_bytes(part.column(place), lower=True)
                found = np.zeros(part.num_rows, bool)
                found[np.searchsorted(at, hits(raw, at, lists)[0], "right") - 1] = True
                found |= part.column(part.num_columns - 1).to_numpy(zero_copy_only=False)
                yield part.select(schema.names).filter(pa.array(found))

    return rows.mapInArrow(run, schema)
