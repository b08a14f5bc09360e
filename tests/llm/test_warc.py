"""WARC packages: round trip, ZIP64, damage."""
import base64
import hashlib
import io
import struct
import zipfile

import pytest

from threadscope.llm import warc as W
from threadscope.llm.common import scratch

PAGES = "page_id long, url string, html string, path string, n int"


def test_round_trip(spark):
    rows = [(1, "http://a/ä b\r\nX: y", "<p>one</p>", "p", 1), (2, None, None, None, None), (3, "u", "", "p", 1),
            (4, "u", "<p>one</p>", "p", 1), (5, "u", "é" * 70_000, "p", 1), (None, "u", "<p>one</p>", "p", 1),
            (7, "u", "\r\n\r\nbody\r\n", "p", 1), (1, "again", "<p>one</p>", "p", 1), (None, "u", "only null", "p", 1)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    manifest = W.write_archives(pages, scratch(spark, "t"), package_bytes=100)
    assert manifest.count() > 3  # small packages: several a task
    records = W.read_archives(manifest, run_bytes=50).cache()
    got = sorted(((r.page_id, r.record_type, r.refers_to, bytes(r.payload) if r.payload is not None else None)
                  for r in records.collect()), key=str)
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h, *_ in rows:
        f = first.get(h or "")
        revisit = f is not None and i != f
        want.append((i, "revisit" if revisit else "response", f if revisit else None, None if revisit else (h or "").encode()))
    assert got == sorted(want, key=str)
    sizes = {(r.page_id, r.payload_bytes, r.payload_digest) for r in W.resolve_revisits(records).collect()}
    assert sizes == {(i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
                     for i, _, h, *_ in rows}


def test_min_bytes_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab", "p", 1), (2, "u", "ab", "p", 1)], PAGES)
    records = W.read_archives(W.write_archives(pages, scratch(spark, "t"), min_bytes=3))
    assert {r.record_type for r in records.collect()} == {"response"}
    none = W.write_archives(pages.limit(0), scratch(spark, "t"))
    assert none.count() == 0 and W.read_archives(none).count() == 0


def _zip64(data: bytes, index: bytes) -> bytes:
    """A package whose directory has its numbers in the ZIP64 fields only."""
    out, central, full = io.BytesIO(), b"", 0xFFFFFFFF
    for name, body in ((W.RECORDS.encode(), data), (W.INDEX.encode(), index)):
        at = out.tell()
        out.write(struct.pack("<4s5H3L2H", b"PK\3\4", 45, 0, 0, 0, 0, 0, len(body), len(body), len(name), 0) + name + body)
        extra = struct.pack("<2H3Q", 1, 24, len(body), len(body), at)
        central += struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, full, full, len(name), len(extra), 0, 0, 0, 0,
                               full) + name + extra
    at = out.tell()
    out.write(central)
    end = out.tell()
    out.write(struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, 2, 2, len(central), at))
    out.write(struct.pack("<4sLQL", b"PK\6\7", 0, end, 1))
    out.write(struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, full, full, 7) + b"comment")
    return out.getvalue()


def test_zip64_directory():
    record = W.warc_record(5, "u", b"hello", W.payload_digest(b"hello"), None, "2024-01-01T00:00:00Z")
    plain = io.BytesIO()
    W.write_package(plain, iter([(5, record), (6, record)]), 1 << 20)
    with zipfile.ZipFile(plain) as z:
        data, index = z.read(W.RECORDS), z.read(W.INDEX)
    for raw in (plain.getvalue(), _zip64(data, index)):
        f = io.BytesIO(raw)
        at, lengths = next(W.record_runs(f, len(raw), 1 << 20))
        assert len(lengths) == 2
        fields, payload = W.parse_record(raw[at:at + lengths[0]])
        assert payload == b"hello" and fields["x-page-id"] == "5"


def test_damage_is_an_error():
    plain = io.BytesIO()
    W.write_package(plain, iter([(5, b"x" * 50)]), 1 << 20)
    raw = plain.getvalue()
    with pytest.raises(ValueError):
        W.members(io.BytesIO(raw[:-30]), len(raw) - 30)
    with zipfile.ZipFile(other := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(W.RECORDS, "x" * 100)
    with pytest.raises(ValueError):  # compressed members cannot be read by range
        list(W.record_runs(other, len(other.getvalue()), 1 << 20))
