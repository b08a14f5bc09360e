"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised through the model's compiled character map: at each
place the longest key of its double-array trie is replaced, and every byte of
the result remembers the byte of the source that it comes from. The library
segments the normalised text, and the ends of the pieces, run through the
alignment, are byte spans of the source.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as pb

from threadscope.llm.common import free_name, prepare

SPACE = "▁"

# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


class CharMap:
    """The compiled character map: a size, the units of a double-array trie
    over UTF-8, and the zero-ended replacements that its values point to."""

    def __init__(self, blob: bytes, kept: list[str] = ()):  # kept: user-defined symbols, never changed
        self.units, self.texts = [], b""
        if blob:
            n = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", n // 4, 4).tolist()
            self.texts = blob[4 + n:]
        self.kept = sorted((k.encode() for k in kept), key=len, reverse=True)
        self.busy = self._places()

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that starts at ``at``."""
        for k in self.kept:
            if raw.startswith(k, at):
                return k, len(k)
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        text = self.texts[found[0]:self.texts.index(b"\0", found[0])]
        return text, found[1]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _keys(self) -> Iterator[bytes]:
        units = self.units
        todo = [(self._offset(units[0]), b"")] if units else []
        while todo:
            node, key = todo.pop()
            for b in range(1, 256):
                at = node ^ b
                if at < len(units) and units[at] & 0x800000FF == b:
                    below = at ^ self._offset(units[at])
                    if units[at] >> 8 & 1:
                        yield key + bytes([b])
                    todo.append((below, key + bytes([b])))

    def _places(self) -> re.Pattern | None:
        """Where a key or a kept symbol may start: a character that is a key, or
        one that starts a longer key and is followed by a second one of those."""
        one, first, second = set(), set(), set()
        for key in [*self._keys(), *self.kept]:
            text = key.decode()
            if len(text) == 1:
                one.add(text)
            else:
                first.add(text[0])
                second.add(text[1])
        both = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]"
        ways = [both(one)] * bool(one) + [f"{both(first)}(?={both(second)})"] * bool(first)
        return re.compile("|".join(ways), re.S) if ways else None

    def parts(self, text: str) -> Iterator[tuple[bytes, int, bool]]:
        """(result, bytes of the source, whether these are the same byte by
        byte) from the start of the text to its end."""
        at = 0
        while at < len(text):
            found = self.busy.search(text, at) if self.busy else None
            stop = found.start() if found else len(text)
            if stop > at:
                plain = text[at:stop].encode()
                yield plain, len(plain), True
                at = stop
            if not found:
                continue
            raw = text[at:at + 64].encode()  # keys are short; one never ends inside a character
            hit = self.longest(raw, 0)
            if hit is None:
                plain = text[at].encode()
                yield plain, len(plain), True
                at += 1
            else:
                yield hit[0], hit[1], False
                at += len(raw[:hit[1]].decode())


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        m = pb.ModelProto()
        m.ParseFromString(model)
        spec = m.normalizer_spec
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.suffix = m.trainer_spec.treat_whitespace_as_suffix
        self.mark = SPACE if spec.escape_whitespaces else " "
        self.map = CharMap(spec.precompiled_charsmap, [p.piece for p in m.pieces if p.type == USER_DEFINED])
        self.written = [str(i) for i in range(len(m.pieces))]
        self.bytes = np.array([len(p.piece.encode()) for p in m.pieces], np.int64)
        # The piece of these does not say which bytes it covers.
        self.byte = np.array([int(p.piece[1:-1], 16) if p.type == BYTE else -1 for p in m.pieces])
        self.unknown = np.array([p.type == UNKNOWN for p in m.pieces])
        self.full = sentencepiece.SentencePieceProcessor(model_proto=model)
        # The library's model without its own normalisation: texts come normalised.
        spec.precompiled_charsmap, spec.add_dummy_prefix = b"", False
        spec.remove_extra_whitespaces, spec.escape_whitespaces = False, False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the byte
        of the source that it comes from."""
        if self.map.busy is None and not self.squeeze and not self.suffix and text:
            raw = np.frombuffer(text.encode(), np.uint8)
            wide = len(self.mark.encode())
            at = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, wide, 1))
            return (self.mark * self.dummy + text.replace(" ", self.mark),
                    np.concatenate([np.zeros(wide * self.dummy, np.int64), at, [len(raw)]]))
        return self._normalise(text)

    def _normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The same for any settings of the model, part by part."""
        parts = []
        for result, n, same in self.map.parts(text):
            if same and self.squeeze:  # each space on its own, so that runs can be squeezed
                parts += [(x, len(x), True) for x in re.split(b"( )", result) if x]
            else:
                parts.append((result, n, same))
        done = first = 0
        if self.squeeze:  # leading spaces go, wherever they come from
            while first < len(parts) and parts[first][0] == b" ":
                done += parts[first][1]
                first += 1
        if first == len(parts):
            return "", np.zeros(1, np.int64)
        mark, out, align = self.mark.encode(), bytearray(), []

        def put(result: bytes, source: int, same: bool) -> None:
            for i, c in enumerate(result):
                piece = mark if c == 0x20 else bytes([c])
                out.extend(piece)
                align.extend([source + i * same] * len(piece))

        if self.dummy and not self.suffix:
            put(b" ", done, False)
        after_space = self.squeeze
        for result, n, same in parts[first:]:
            kept = result.lstrip(b" ") if after_space else result
            put(kept, done + (len(result) - len(kept)) * same, same)
            if kept:
                after_space = self.squeeze and kept.endswith(b" ")
            done += n
        while self.squeeze and out.endswith(mark):
            done = align[-len(mark)]
            del out[-len(mark):], align[-len(mark):]
        if self.dummy and self.suffix:
            put(b" ", done, False)
        return out.decode(), np.array([*align, done], np.int64)

    def _lengths(self, norm: str, ids: np.ndarray) -> np.ndarray:
        """Bytes of the normalised text that each piece covers."""
        lengths = self.bytes[ids]
        value = self.byte[ids]
        if (value >= 0).any():  # the bytes of one character: the last of them covers it
            inner = (value >= 0x80) & (value < 0xC0)
            last = np.flatnonzero(inner & ~np.append(inner[1:], False))
            lengths[value >= 0] = value[value >= 0] < 0x80
            lengths[last] = last - np.flatnonzero(value >= 0xC0) + 1
        unknown = np.flatnonzero(self.unknown[ids])
        if len(unknown):
            names = self.plain.encode(norm, out_type=str)
            lengths[unknown] = [len(names[i].encode()) for i in unknown]
        return lengths

    def _ids(self, norm: str) -> list[int]:
        return self.plain.encode(norm, num_threads=1) if norm else []

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids, and start and end byte of each piece in the source. Of the bytes
        that stand for one character, the last has its span, the others an empty one."""
        norm, align = self.normalise(text)
        ids = self._ids(norm)
        ends = np.cumsum(self._lengths(norm, np.array(ids, np.int64)))
        return ids, align[np.concatenate([[0], ends[:-1]])] if ids else align[:0], align[ends]

    def decode(self, ids: list[int]) -> str:
        return self.full.decode(ids) if ids else ""

    def digest(self, text: str) -> tuple[int, str, str, int]:
        """Number of ids, SHA-256 of them, SHA-256 of the decoded text, and bytes
        of the source that the spans cover."""
        ids, starts, ends = self.encode(text)
        written = ",".join(map(self.written.__getitem__, ids))
        return (len(ids), hashlib.sha256(written.encode()).hexdigest(),
                hashlib.sha256(self.decode(ids).encode()).hexdigest(), int((ends - starts).sum()))


_codecs: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    key = hashlib.sha256(model).digest()
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def _model(spark, path: str):
    """The model file, of bounded size, sent to each executor once."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _texts(column: pa.Array) -> list[str]:
    return column.cast(pa.large_string()).fill_null("").to_pylist()


def encode(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` with ids, starts and ends: the ids of the whole text (null and
    empty: none), and the bytes of the source that each piece comes from.
    Columns of those names are replaced; all rows and other columns stay."""
    spark = prepare(df)
    model, df = _model(spark, model_path), df.drop("ids", "starts", "ends")
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("starts", T.ArrayType(T.LongType())),
                           T.StructField("ends", T.ArrayType(T.LongType()))])
    place = df.columns.index(text)

    def run(batches):
        c = codec(model.value)
        for batch in batches:
            found = [c.encode(t) for t in _texts(batch.column(place))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.int64())),
                 pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                [*batch.schema.names, "ids", "starts", "ends"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the text that the ids decode to (null: empty)."""
    spark = prepare(df)
    model, df = _model(spark, model_path), df.drop(out)
    place = df.columns.index(ids)

    def run(batches):
        c = codec(model.value)
        for batch in batches:
            texts = [c.decode([i for i in x if i is not None]) if x else "" for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def round_trip(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` without its text, with what encoding and decoding it gives: n_tokens,
    ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the
    decoded text) and covered_bytes (bytes of the source that the pieces'
    spans cover). Long lists of ids stay in the Python worker."""
    spark = prepare(df)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"]
    model, df = _model(spark, model_path), df.drop(*(n for n in names if n != text))
    source = free_name(df, "_source")
    df = df.withColumn(source, F.col(f"`{text}`").cast("string")).drop(text)
    kept = [f for f in df.schema.fields if f.name != source]
    schema = T.StructType([*kept, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.StringType()),
                           T.StructField(names[2], T.StringType()), T.StructField(names[3], T.LongType())])

    def run(batches):
        c = codec(model.value)
        for batch in batches:
            found = [c.digest(t) for t in _texts(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array([f[i] for f in found], t) for i, t in
                                        enumerate((pa.int64(), pa.string(), pa.string(), pa.int64())))],
                [*batch.schema.names[:-1], *names])

    return df.mapInArrow(run, schema)
