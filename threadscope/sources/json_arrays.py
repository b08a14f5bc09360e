"""Elements of JSON array files, each file read by as many tasks as it has splits.

Spark's text reader splits a file at a separator. With ``}`` as separator every
task gets the pieces between closing braces of its byte range, whichever file
system they come from. Whether a range starts inside a string, and how deep, is
not known to its task. So a first pass over the ranges of files that have
several sums up each of them: whether its quotes flip the string state, and how
much deeper it ends, for either state at its start. Folded in file order, these
give every range its state, and a second pass cuts the ranges at the commas of
the outermost array. An element that lies in several ranges is put together
from its pieces. Files that are no JSON array, or hold a broken element, are
told apart at the end, as a whole.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadscope.session import scratch_path, ship_package

log = logging.getLogger(__name__)

#: A VARIANT holds no more bytes than this.
VARIANT_BYTES = 128 << 20
#: Values nested deeper than this are kept as their JSON text.
DEPTH = 200
#: Bytes of rows that are sent on at a time.
SEND = 8 << 20
#: Bytes that are looked at at a time; the arrays over them take some thirty times as many.
STEP = 256 << 10

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_ROWS = "file_path string, block long, idx long, kind string, value string, piece binary, reason string"
#: The summary of a range that opens and closes one array.
_ONE_ARRAY = json.dumps([1, 0, False])
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]


# --- one byte range -----------------------------------------------------------

def steps(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``STEP`` bytes; none ends between a backslash and what it escapes."""
    if len(data) <= STEP:
        yield data
        return
    at = 0
    while at < len(data):
        part = data[at:at + STEP]
        if (len(part) - len(part.rstrip(b"\\"))) % 2:
            part = data[at:at + STEP + 1]
        yield part
        at += len(part)


def structure(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether the quotes up to it leave a string open, if none
    was at the start; and 1 for an opening bracket, -1 for a closing one."""
    quote = raw == 0x22
    back = np.flatnonzero(raw == 0x5C)
    if len(back):  # a quote behind an odd run of backslashes is part of its string
        last = np.append(np.diff(back) > 1, True)
        first = np.append(True, last[:-1])
        run = back[last] - back[first] + 1
        after = back[last][run % 2 == 1] + 1
        quote[after[after < len(raw)]] = False
    inside = (np.cumsum(quote.view(np.uint8), dtype=np.uint8) & 1).astype(bool)
    depth = ((raw == 0x5B) | (raw == 0x7B)).astype(np.int8) - ((raw == 0x5D) | (raw == 0x7D))
    return inside, depth


def repaired(value, depth: int = DEPTH):
    """``value`` with what a VARIANT cannot hold replaced: numbers beyond a
    double by null, containers nested deeper than ``depth`` by their JSON text."""
    if isinstance(value, float):
        return value if -float("inf") < value < float("inf") else None
    if not isinstance(value, dict | list):
        return value
    if not depth:
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, dict):
        return {k: repaired(v, depth - 1) for k, v in value.items()}
    return [repaired(v, depth - 1) for v in value]


class _Element:
    """Parses element texts the way ``json.load`` parses a file: a repeated key's
    last value counts, NaN and infinities are numbers (null here)."""

    def __init__(self):
        self.odd = False
        self.decoder = json.JSONDecoder(object_pairs_hook=self._pairs, parse_float=self._float, parse_constant=self._constant)

    def _pairs(self, pairs):
        found = dict(pairs)
        self.odd |= len(found) < len(pairs)
        return found

    def _float(self, text):
        value = float(text)
        self.odd |= value in (float("inf"), -float("inf"))
        return value

    def _constant(self, _):
        self.odd = True

    def __call__(self, raw: bytes, deep: bool) -> tuple[str, str | None, str | None]:
        """(kind, text, reason): object, other (no record), large, empty or bad."""
        try:
            text = raw.decode()
            self.odd = deep
            if not text.strip(" \t\n\r"):
                return "empty", None, None
            value = self.decoder.decode(text)
            if not isinstance(value, dict):
                return "other", None, None
            if self.odd:
                text = json.dumps(repaired(value))
                raw = text.encode()
        except RecursionError:
            return "bad", None, "nested too deeply"
        except ValueError as e:
            return "bad", None, str(e)[:200]
        if len(raw) > VARIANT_BYTES:
            return "large", None, f"{len(raw)} bytes"
        return "object", text, None


class RangeScanner:
    """Cuts one byte range at the commas of the outermost array."""

    def __init__(self, in_string: bool, depth: int):
        self.in_string, self.depth = in_string, depth
        self.parse = _Element()
        self.open = depth > 0  # inside the array
        self.whole = False  # the current piece began in this range
        self.buffer: list[bytes] = []
        self.deep = self.wrong = False
        self.idx = self.opened = 0

    def feed(self, data: bytes) -> Iterator[tuple]:
        """(idx, kind, value, piece, reason) of the pieces that end here."""
        for part in steps(data):
            yield from self._feed(part)

    def _feed(self, data: bytes) -> Iterator[tuple]:
        raw = np.frombuffer(data, np.uint8)
        inside, delta = structure(raw)
        if self.in_string:
            inside = ~inside
        delta[inside] = 0
        # Depths count where something opens, closes or ends only.
        marks = np.flatnonzero((delta != 0) | ((raw == 0x2C) & ~inside))
        change = delta[marks]
        depth = self.depth + np.cumsum(change, dtype=np.int64)
        cuts = marks[np.where(change < 0, depth == 0, depth == 1)]
        if (depth < 0).any():
            self.wrong = True
        if not self.depth or (depth == 0).any():
            everywhere = np.repeat(np.append(self.depth, depth), np.diff(marks, prepend=0, append=len(raw)))
            self.wrong |= bool(((everywhere == 0) & (inside | ((delta == 0) & ~_SPACE[raw]))).any())
        deep = max(self.depth, int(depth.max(initial=0))) > DEPTH
        at = 0
        for cut in cuts.tolist():
            if delta[cut] > 0:  # the array opens
                self.opened += 1
                self.wrong |= bool(raw[cut] != 0x5B)
                self.open, self.whole, self.buffer, self.deep = True, True, [], False
            else:
                self.buffer.append(data[at:cut])
                self.deep |= deep
                yield self._piece()
                self.buffer, self.deep, self.whole = [], False, True
                if delta[cut] < 0:
                    self.open = False
                    self.wrong |= bool(raw[cut] != 0x5D)
                else:
                    self.idx += 1
            at = cut + 1
        if self.open:
            self.buffer.append(data[at:])
            self.deep |= deep
        if len(raw):
            self.in_string = bool(inside[-1])
        if len(marks):
            self.depth = int(depth[-1])

    def _piece(self) -> tuple:
        raw = b"".join(self.buffer)
        if not self.whole:
            return self.idx, "partial", None, raw, None
        kind, value, reason = self.parse(raw, self.deep)
        return self.idx, kind, value, None, reason

    def end(self) -> Iterator[tuple]:
        """What is left of the range, and its summary: commas, arrays opened, and where it ends."""
        if self.open:
            yield self.idx, "partial", None, b"".join(self.buffer), None
        if self.wrong:
            yield self.idx, "bad", None, None, "no JSON array"
        yield self.idx, "range", json.dumps([self.opened, int(self.depth), bool(self.in_string)]), None, None


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(path, block, values with the separator between them), in order, about ``STEP`` bytes
    or one value at a time; a new range each time path or block changes."""
    for batch in batches:
        paths, blocks, values = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2)
        step = np.cumsum(pc.binary_length(values).to_numpy(), dtype=np.int64) // STEP
        low = 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or blocks[i] != blocks[low] or paths[i] != paths[low] or step[i] != step[low]:
                yield paths[low], int(blocks[low]), values.slice(low, i - low).to_pylist()
                low = i


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], _NAMES)


# --- files ----------------------------------------------------------------------

def _fragments(spark: SparkSession, paths: list[str], glob: str) -> DataFrame:
    """(file_path, block, value, part of a larger file): the bytes between closing braces, in order within a range."""
    meta = F.col("_metadata")
    return spark.read.option("pathGlobFilter", glob).text(paths, lineSep="}").select(
        meta["file_path"].alias("file_path"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("value"),
        (meta["file_block_length"] < meta["file_size"]).alias("shared"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: whether its quotes flip the string state, and the change
    of depth if it starts outside a string, or inside one."""
    now, odd, change = None, False, [0, 0]
    names = ["file_path", "block", "flips", "outside", "inside"]
    found = []
    for path, block, values in _by_range(batches):
        if (path, block) != now:
            if now:
                found.append((*now, odd, *change))
            now, odd, change = (path, block), False, [0, 0]
        for part in steps(b"}".join([*values, b""])):
            inside, delta = structure(np.frombuffer(part, np.uint8))
            change[odd] += int(delta[~inside].sum())
            change[not odd] += int(delta[inside].sum())
            odd ^= bool(inside[-1])
    if now:
        found.append((*now, odd, *change))
        yield pa.RecordBatch.from_pydict({n: [f[i] for f in found] for i, n in enumerate(names)})


def range_states(summaries: list[tuple]) -> dict[tuple[str, int], tuple[bool, int, bool]]:
    """(in a string, depth, the file's last range) at the start of each range,
    from (path, block, flips, outside, inside) of each."""
    states: dict[tuple[str, int], tuple[bool, int, bool]] = {}
    last, in_string, depth = (None, 0), False, 0
    for p, block, flips, outside, inside in sorted(summaries):
        if p != last[0]:
            in_string, depth = False, 0
        else:
            states[last] = (*states[last][:2], False)
        last = (p, block)
        states[last] = (in_string, depth, True)
        depth += inside if in_string else outside
        in_string ^= flips
    return states


def _cut(states):
    """Task function: the pieces of each range, given the states of those that are part of a larger file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = scanner = None
        held, size = [], 0

        def done(last: bool):
            # The reader drops the separator: all fragments but the file's last one had it.
            for row in [] if last else scanner.feed(b"}"):
                yield (*now, *row)
            for row in scanner.end():
                yield (*now, *row)

        def all_rows():
            nonlocal now, scanner
            shared, last, waiting = False, True, False
            for batch in batches:
                flags = batch.column(3).to_pylist()
                at = 0
                for path, block, values in _by_range([batch]):
                    if (path, block) != now:
                        if now:
                            yield from done(last)
                        now, shared, waiting = (path, block), flags[at], False
                        state = states.get(now) if shared else (False, 0, True)
                        if state is None:
                            yield (*now, 0, "unknown", None, None, None)  # cut anew, see array_elements
                            state = (False, 0, True)
                        scanner, last = RangeScanner(*state[:2]), state[2]
                    for row in scanner.feed((b"}" if waiting else b"") + b"}".join(values)):
                        yield (*now, *row)
                    waiting, at = True, at + len(values)
            if now:
                yield from done(last)

        for row in all_rows():
            if row[3] == "other":
                continue
            held.append(row)
            size += len(row[4] or "") + len(row[5] or b"") + 100
            if size > SEND:
                yield _rows(held)
                held, size = [], 0
        if held:
            yield _rows(held)
    return run


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that lie in several ranges, parsed like the others."""
    parse = _Element()
    for batch in batches:
        for i in range(batch.num_rows):
            raw = b"".join(p["piece"] for p in batch.column(2)[i].as_py())
            kind, value, reason = parse(raw, deep=raw.count(b"[") + raw.count(b"{") > DEPTH)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([kind]), pa.array([value], pa.string()),
                 pa.array([reason], pa.string())], ["file_path", "pos", "kind", "value", "reason"])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _states(spark: SparkSession, fragments: DataFrame, paths: list[str], glob: str) -> dict:
    """The states of the ranges of files that have several. No file up to the
    cost of opening one is ever split, so that smaller files need no pass."""
    longest = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths).agg(F.max("length")).first()[0]
    number, unit = re.fullmatch(r"(\d+) *([kmgt]?)i?b?", spark.conf.get("spark.sql.files.openCostInBytes").lower()).groups()
    if (longest or 0) <= int(number) << 10 * " kmgt".index(unit or " "):
        return {}
    # One row a range of a file with several: less than one for every spark.sql.files.maxPartitionBytes of input.
    found = fragments.filter("shared").mapInArrow(_summaries, "file_path string, block long, flips boolean, outside long, inside long")
    return range_states([tuple(r) for r in found.collect()])


def array_elements(spark: SparkSession, paths: list[str], glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Elements of the JSON array files in the folders, or of the files, ``paths``.

    Returns (file_path, pos, value) of every record (``pos``: its position
    among all elements of its file; elements that are not objects are left
    out), and a report (file_path, pos, reason) of what is not in the first:
    files as a whole (pos null) that do not parse as ``json.load`` does it or
    hold no array, and records of more than 128 MiB. A repeated key's last
    value counts; NaN, infinities and numbers beyond a double become null;
    values nested deeper than 200 levels become their JSON text; a byte-order
    mark and empty files are passed over. The cut elements are written once to the shared folder.
    """
    ship_package(spark)
    fragments = _fragments(spark, paths, glob)
    for _ in range(3):
        rows = _stored(fragments.mapInArrow(_cut(_states(spark, fragments, paths, glob)), _ROWS), "json-elements")
        n = rows.agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("unknown", "partial", "bad", "empty")),
                     F.count_if((F.col("kind") == "range") & (F.col("value") != _ONE_ARRAY)).alias("odd")).first()
        # Executors that come or go between the passes change the ranges; then both run again.
        if not n.unknown:
            break
    else:
        raise RuntimeError("the byte ranges of the files changed between the passes; set spark.sql.files.minPartitionNum")
    if not (n.partial or n.bad or n.empty or n.odd):  # every range is one whole file, and nothing is wrong with it
        elements = rows.filter("kind in ('object', 'large')").withColumnRenamed("idx", "pos")
        return elements.filter("kind = 'object'").select("file_path", "pos", "value"), \
            elements.filter("kind = 'large'").select("file_path", "pos", "reason")
    ends = F.from_json("value", "array<string>")
    ranges = rows.filter("kind = 'range'").select("file_path", "block", "idx", ends[0].cast("int").alias("opened"), ends[1].cast("long").alias("depth"),
                                                  ends[2].cast("boolean").alias("in_string"))
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("file_path", "block", F.sum("idx").over(earlier).alias("before")).filter("before > 0")
    at = ["file_path", "block"]
    placed = (rows.filter("kind in ('object', 'large', 'partial', 'empty')").join(offsets, at, "left")
              .withColumn("pos", F.col("idx") + F.coalesce("before", F.lit(0))))
    pieces = (placed.filter("kind = 'partial'").groupBy("file_path", "pos")
              .agg(F.sort_array(F.collect_list(F.struct("block", "piece"))).alias("pieces")))
    joined = _stored(pieces.mapInArrow(_join_pieces, "file_path string, pos long, kind string, value string, reason string"), "json-joined")
    # Files as a whole: one array from the first to the last byte, and no broken or missing element.
    last = F.max_by(F.struct("depth", "in_string"), "block")
    whole = ranges.groupBy("file_path").agg(F.sum("opened").alias("opened"), F.sum("idx").alias("commas"), last.alias("last"))
    no_array = whole.filter("opened <> 1 or last.depth <> 0 or last.in_string").select("file_path", F.lit("no JSON array").alias("reason"))
    broken = rows.filter("kind = 'bad'").select("file_path", "reason").union(joined.filter("kind = 'bad'").select("file_path", "reason"))
    gaps = (placed.filter("kind = 'empty'").select("file_path").union(joined.filter("kind = 'empty'").select("file_path"))
            .join(whole.filter("commas > 0").select("file_path"), "file_path").select("file_path", F.lit("an element is missing").alias("reason")))
    skipped = _stored(no_array.union(broken).union(gaps).groupBy("file_path").agg(F.min("reason").alias("reason")), "json-skipped")
    kept = ["file_path", "pos", "kind", "value", "reason"]
    elements = placed.select(*kept).filter("kind in ('object', 'large')").union(joined.select(*kept)).join(skipped.select("file_path"), "file_path", "left_anti")
    report = (skipped.select("file_path", F.lit(None).cast("long").alias("pos"), "reason")
              .union(elements.filter("kind = 'large'").select("file_path", "pos", "reason")))
    return elements.filter("kind = 'object'").select("file_path", "pos", "value"), report
