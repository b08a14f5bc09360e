"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs (at line ends, and inside long lines after a
word whose hash says so, so that an edit moves no later cut). The digest of
each goes into three cells of a table: a count, the xor of the digests and
the xor of their checks. Subtracting the tables of two texts cancels what they
share, and peeling cells that hold a single digest recovers the digests that
differ. If peeling gets stuck, the sketches are made anew, four times as
large and with other cells.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.llm.common import mix, prepare, shuffle_partitions, slices, span_hashes, text_bytes, word_spans

#: Cells of each third of a fingerprint's table.
CELLS = 8
#: A long line is cut after one word in so many.
CUT = 8
#: Cells of a third that are held at a time, for all pairs together (a cell takes 20 bytes in each of three tables).
ROOM = 1 << 17

_U = np.uint64


def paragraphs(column) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the texts' paragraphs, and n + 1 offsets. A paragraph that a
    text repeats gets another digest each time, so all of a text's differ."""
    raw, at = text_bytes(column)
    starts, ends, words_at = word_spans(raw, at)
    if not len(starts):
        return np.zeros(0, _U), np.zeros(len(at), np.int64)
    hashes = span_hashes(raw, starts, ends)
    lines = np.concatenate([[0], np.cumsum(raw == 10)])
    cut = (hashes % _U(CUT) == 0) | np.append(lines[ends[:-1]] < lines[starts[1:]], True)
    cut[words_at[1:][words_at[1:] > words_at[:-1]] - 1] = True  # the last word of a text
    last = np.flatnonzero(cut)
    first = np.append(0, last[:-1] + 1)
    digests = span_hashes(raw, starts[first], ends[last], 3)
    places = np.searchsorted(last, words_at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(places))
    order = np.lexsort((digests, text))
    d, t = digests[order], text[order]
    new = np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))
    nth = np.arange(len(d)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    out = np.empty_like(d)
    out[order] = mix(d + nth.astype(_U) * _U(0xA24BAED4963EE407), 5)
    return out, places


class Sketches:
    """Tables of many texts: count, xor of digests and xor of checks by cell."""

    def __init__(self, digests: np.ndarray, at: np.ndarray, cells: int):
        n = len(at) - 1
        self.cells = cells
        self.count = np.zeros((n, 3 * cells), np.int32)
        self.key = np.zeros((n, 3 * cells), _U)
        self.check = np.zeros((n, 3 * cells), _U)
        text = np.repeat(np.arange(n), np.diff(at))
        self._toggle(text, digests, np.ones(len(digests), np.int32))

    def places(self, digests: np.ndarray) -> list[np.ndarray]:
        """A cell in each third of the table; another size has other cells."""
        return [i * self.cells + (mix(digests, 10 * self.cells + i) % _U(self.cells)).astype(np.int64) for i in range(3)]

    def _toggle(self, text: np.ndarray, digests: np.ndarray, sign: np.ndarray) -> None:
        check = mix(digests, 77)
        for cell in self.places(digests):
            np.add.at(self.count, (text, cell), sign)
            np.bitwise_xor.at(self.key, (text, cell), digests)
            np.bitwise_xor.at(self.check, (text, cell), check)

    def minus(self, other: Sketches) -> Sketches:
        out = object.__new__(Sketches)
        out.cells, out.count = self.cells, self.count - other.count
        out.key, out.check = self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, digest, sign) of what differs, and which texts came out empty."""
        found = []
        while True:
            text, cell = np.nonzero(np.abs(self.count) == 1)
            key = self.key[text, cell]
            pure = self.check[text, cell] == mix(key, 77)
            text, cell, key = text[pure], cell[pure], key[pure]
            if not len(text):
                break
            sign = self.count[text, cell]
            order = np.lexsort((key, text))
            keep = order[np.append(True, (key[order][1:] != key[order][:-1]) | (text[order][1:] != text[order][:-1]))]
            text, key, sign = text[keep], key[keep], sign[keep]
            self._toggle(text, key, -sign)
            found.append((text, key, sign))
        empty = ~(self.count.any(axis=1) | self.key.any(axis=1) | self.check.any(axis=1))
        if not found:
            none = np.zeros(0, np.int64)
            return none, none.astype(_U), none.astype(np.int32), empty
        return *(np.concatenate(x) for x in zip(*found, strict=True)), empty

    def written(self, at: np.ndarray) -> list[str]:
        """A fingerprint: number of paragraphs, cells, and the table in base64."""
        tables = np.concatenate([self.key, self.check & _U(0xFFFFFFFF), self.count.astype(np.int64).view(_U) & _U(0xFFFF)], axis=1)
        c = 3 * self.cells
        return [f"iblt1:{n}:{self.cells}:" + base64.b64encode(
            row[:c].tobytes() + row[c:2 * c].astype(np.uint32).tobytes() + row[2 * c:].astype(np.uint16).tobytes()).decode()
            for n, row in zip(np.diff(at).tolist(), tables, strict=True)]


def _pick(digests: np.ndarray, at: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests of some texts, one text after the other."""
    n = at[texts + 1] - at[texts]
    out = np.concatenate([[0], np.cumsum(n)])
    return digests[np.repeat(at[texts] - out[:-1], n) + np.arange(out[-1])], out


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], cells: int = CELLS
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, digest, sign) of the paragraphs that only the first (+1) or only the
    second (-1) text of each pair has. Sketches of ``cells`` come first; pairs
    that do not peel go on with four times as many."""
    left = np.arange(len(a[1]) - 1)
    found = []
    while len(left):
        one, two = _pick(*a, left), _pick(*b, left)
        text, key, sign, done = Sketches(*one, cells).minus(Sketches(*two, cells)).peel()
        kept = done[text]
        found.append((left[text[kept]], key[kept], sign[kept]))
        left = left[~done]
        cells *= 4
        if len(left) * cells > ROOM and len(left) > 1:  # large tables: a few texts at a time
            for part in np.array_split(left, min(len(left), -(-len(left) * cells // ROOM))):
                t, k, s = differences(_pick(*a, part), _pick(*b, part), cells)
                found.append((part[t], k, s))
            break
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def likeness(a, b) -> np.ndarray:
    """Share of paragraphs that two texts have in common, of those of both
    (twice the common ones by the sum; two texts without any: 1)."""
    n = (np.diff(a[1]) + np.diff(b[1])).astype(np.float64)
    text, _, _ = differences(a, b)
    differ = np.bincount(text, minlength=len(n))
    return np.where(n > 0, (n - differ) / np.maximum(n, 1), 1.0)


def fingerprints(column, cells: int = CELLS) -> list[str]:
    digests, at = paragraphs(column)
    return Sketches(digests, at, cells).written(at)


def edited(text: str, following: str) -> str:
    """``text``, its last floor(n / 2) code points replaced by the first as many
    (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _at_most(cuts: list[int], x: Column) -> Column:
    """How many of the sorted cuts are x or less: the group of a coarse list,
    then the place within the group, so about 2 * sqrt(n) comparisons a row."""
    width = max(1, int(len(cuts) ** 0.5))
    every, coarse = (F.array(*map(F.lit, c)).cast("array<long>") for c in (cuts, cuts[::width]))
    group = F.size(F.filter(coarse, lambda c: c <= x)) - 1
    inside = F.slice(every, group * width + 1, F.lit(width))
    return F.when(group < 0, 0).otherwise(group * width + F.size(F.filter(inside, lambda c: c <= x)))


def with_next(df: DataFrame, id_col: str, text: str, run, schema: T.StructType, pieces: int | None = None) -> DataFrame:
    """``run`` (id column, texts, texts of the next rows -> RecordBatch) over all
    rows in ascending order of id (null last; rows of one id by text), the
    first row following the last.

    The rows are cut into as many ranges as there are shuffle partitions, at
    ids that occur in the table. A range is sent its rows, and as a guest the
    first id of the range after it, so texts move once."""
    spark = prepare(df)
    pieces = pieces or shuffle_partitions(spark)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("place_of", F.coalesce("id", F.lit((1 << 63) - 1)))
    share = F.array(*(F.lit(i / pieces) for i in range(pieces)))
    least, found = rows.agg(F.min("place_of"), F.percentile_approx("place_of", share, 100 * pieces)).first()
    cuts = [] if least is None else sorted({least, *found})
    if not cuts:
        return spark.createDataFrame([], schema)
    x = F.col("place_of")
    own = (_at_most(cuts, x) - 1).cast("int")
    places = F.array(F.struct(own.alias("range"), F.lit(False).alias("guest")))
    before = F.array(F.struct(F.pmod(own - 1, F.lit(len(cuts))).alias("range"), F.lit(True).alias("guest")))
    first = F.array_contains(F.array(*map(F.lit, cuts)).cast("array<long>"), x)
    dealt = (rows.select("id", "text", "place_of", F.inline(F.when(first, F.concat(places, before)).otherwise(places)))
             .repartition(len(cuts), "range").sortWithinPartitions("range", "guest", "place_of", "text"))

    def walk(batches):
        held = None  # the row that waits for the next one, with its range
        for batch in batches:
            for part in slices(batch, "text"):
                out, nexts = [], []
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    _, t, where, guest = row
                    if guest and (held is None or held[2] != where):
                        continue  # another row with the id of the guest
                    if held is not None:
                        out.append(held)
                        nexts.append(t)
                    held = None if guest else row
                if out:
                    yield run(pa.array([r[0] for r in out], pa.int64()), [r[1] for r in out], nexts)

    return dealt.select("id", "text", "range", "guest").mapInArrow(walk, schema)


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """For every row: n_chars (code points), edited_sha256, fingerprint and
    edited_fingerprint, near_edited and near_next (likeness to the edited text
    and to the next row's text), and paragraphs and edited_paragraphs.

    A null text is an empty one. The next row is that of the next id in
    ascending order, after the last the first; a null id comes last, and rows
    of one id follow each other by text. A single row is its own next. An
    empty table gives no rows; other columns are not read.
    """
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_chars", T.LongType()),
                           *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
                           *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")),
                           *(T.StructField(c, T.LongType()) for c in ("paragraphs", "edited_paragraphs"))])

    def run(ids, texts, nexts):
        changed = [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
        a, b, c = (paragraphs(pa.array(x, pa.large_string())) for x in (texts, changed, nexts))
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array(Sketches(*a, cells).written(a[1])), pa.array(Sketches(*b, cells).written(b[1])),
            pa.array(likeness(a, b)), pa.array(likeness(a, c)),
            pa.array(np.diff(a[1]).astype(np.int64)), pa.array(np.diff(b[1]).astype(np.int64))], schema.names)

    return with_next(docs, id_col, text, run, schema)
