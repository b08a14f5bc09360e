"""WARC records in ZIP packages: writer, and a reader that range-reads.

A package is a ZIP file with two stored (uncompressed) members: the records,
each a gzip member of its own (``archive/data.warc.gz``), and one JSON line a
record with its place (``indexes/index.cdxj``). The reader parses the end
record, its ZIP64 form and the central directory, finds the two members, and
reads runs of records by byte range; nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadscope.llm.common import free_name, prepare, shuffle_partitions, stored

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A package is closed once its records take this many bytes.
PACKAGE_BYTES = 64 << 20
#: Records are read in runs of about this many bytes.
RUN_BYTES = 4 << 20
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style URI (``file:/x`` and plain paths too)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


# --- writing ----------------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None, date: str) -> bytes:
    """One record. A revisit (``refers_to`` set) holds the HTTP header only."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
            ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=-._~")))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                 ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_package(out, records: Iterator[tuple[int | None, bytes]], most: int) -> tuple[int, int, bool]:
    """Write one package to the stream ``out``; (records, bytes of records,
    whether records may be left)."""
    index, at, more = [], 0, False
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True) as member:
            for page_id, record in records:
                gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = gz.compress(record) + gz.flush()
                member.write(data)
                index.append(json.dumps({"page_id": page_id, "offset": at, "length": len(data)}))
                at += len(data)
                if at >= most:
                    more = True
                    break
        with z.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            for line in index:
                member.write(line.encode() + b"\n")
    return len(index), at, more


def write_archives(pages: DataFrame, out_dir: str, id_col: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a WARC record for every row to ZIP packages below ``out_dir``;
    returns their manifest (path, records, bytes).

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads
    of at least ``min_bytes`` bytes, those with the smallest id are responses
    and all others revisits of it; a null id counts as larger than any other,
    and where all ids of a payload are null, all rows are responses. Rows that
    repeat the smallest id are responses too. Smaller payloads are always
    responses. Other columns are not read.

    Every task attempt writes files of new names, and only those of the
    attempt that succeeded come into the manifest: a lost executor leaves at
    most files that no manifest names.
    """
    prepare(pages)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"sha": F.sha1("html"), "n": F.octet_length("html")})
    first = (rows.filter(F.col("n") >= min_bytes).groupBy("sha", "n")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("c"))
             .filter("c > 1 and first is not null").drop("c"))
    # Not broadcast: there may be as many groups of equal payloads as pages. AQE splits the rows of a large one.
    rows = (rows.join(first.hint("merge"), ["sha", "n"], "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
            .select("page_id", "url", "html", "refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for p, u, h, r in zip(*(batch.column(i) for i in range(4)), strict=True):
                    payload = h.as_py().encode()
                    yield p.as_py(), warc_record(p.as_py(), u.as_py(), payload, payload_digest(payload), r.as_py(), date)

        todo = records()
        held = next(todo, None)
        fs, folder = file_system(out_dir)
        part = TaskContext.get().partitionId()
        while held is not None:
            name = f"part-{part:05d}-{uuid.uuid4().hex}.zip"
            fs.create_dir(folder, recursive=True)
            with fs.open_output_stream(f"{folder}/{name}") as out:
                n, size, more = write_package(out, _chain(held, todo), package_bytes)
            yield pa.RecordBatch.from_pydict({"path": [f"{out_dir}/{name}"], "records": [n], "bytes": [size]})
            held = next(todo, None) if more else None

    return stored(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def _chain(first, rest):
    yield first
    yield from rest


# --- reading ----------------------------------------------------------------

def _at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    data = f.read(n)
    if len(data) < n:
        raise ValueError("the archive is cut off")
    return data


def directory(f, size: int) -> tuple[int, int, int]:
    """Offset, bytes and entries of the central directory; from the ZIP64 end
    record where the plain one says so."""
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = _at(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end record: not a ZIP archive")
    disk, start_disk, here, entries, length, offset, _ = struct.unpack_from("<4H2LH", tail, end + 4)
    if 0xFFFF in (disk, start_disk, here, entries) or 0xFFFFFFFF in (length, offset):
        place = tail_at + end - 20
        if place >= 0 and (locator := _at(f, place, 20))[:4] == b"PK\x06\x07":
            _, at64, _ = struct.unpack_from("<LQL", locator, 4)
            record = _at(f, at64, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 end record is not where its locator says")
            disk, start_disk, here, entries, length, offset = struct.unpack_from("<2L4Q", record, 16)
    if disk or start_disk or here != entries:
        raise ValueError("archives over several disks are not read")
    return offset, length, entries


def members(f, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset of the data, bytes) of the stored members."""
    offset, length, entries = directory(f, size)
    raw = _at(f, offset, length)
    found, at = {}, 0
    for _ in range(entries):
        if raw[at:at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<2H", raw, at + 8)
        packed, full, name_n, extra_n, comment_n = struct.unpack_from("<2L3H", raw, at + 20)
        local = struct.unpack_from("<L", raw, at + 42)[0]
        name = raw[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = raw[at + 46 + name_n:at + 46 + name_n + extra_n], 0
        while x + 4 <= len(extra):
            tag, n = struct.unpack_from("<2H", extra, x)
            if tag == 1:  # ZIP64: 8 bytes for each field that is full, in this order
                wide, y = [full, packed, local], x + 4
                for i, v in enumerate(wide):
                    if v == 0xFFFFFFFF:
                        wide[i] = struct.unpack_from("<Q", extra, y)[0]
                        y += 8
                full, packed, local = wide
            x += 4 + n
        at += 46 + name_n + extra_n + comment_n
        if method == zipfile.ZIP_STORED and not flags & 1 and packed == full:
            head = _at(f, local, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header for {name}")
            found[name] = (local + 30 + sum(struct.unpack_from("<2H", head, 26)), full)
    return found


def record_runs(f, size: int, run_bytes: int) -> Iterator[tuple[int, list[int]]]:
    """(offset in the archive, lengths of the records that follow each other there)."""
    stored_members = members(f, size)
    if RECORDS not in stored_members or INDEX not in stored_members:
        raise ValueError(f"no stored {RECORDS} and {INDEX}")
    base, room = stored_members[RECORDS]
    index_at, index_n = stored_members[INDEX]
    start, lengths, rest, done = base, [], b"", 0
    while done < index_n or rest:
        data = rest + (_at(f, index_at + done, min(1 << 20, index_n - done)) if done < index_n else b"\n")
        done = min(index_n, done + (1 << 20))
        lines = data.split(b"\n")
        rest = lines.pop() if done < index_n else b""
        for line in filter(None, lines):
            entry = json.loads(line)
            at, n = base + entry["offset"], entry["length"]
            if entry["offset"] < 0 or entry["offset"] + n > room:
                raise ValueError("an index entry lies outside the records")
            if lengths and (at != start + sum(lengths) or at + n - start > run_bytes):
                yield start, lengths
                lengths = []
            if not lengths:
                start = at
            lengths.append(n)
        if done >= index_n:
            break
    if lengths:
        yield start, lengths


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the HTTP payload of a record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if len(block) < int(fields["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("the record is cut off")
    return fields, block.partition(b"\r\n\r\n")[2]


def read_archives(manifest: DataFrame, with_payload: bool = True, run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row a record of the packages that ``manifest`` (path, ...) lists:
    page_id, url, record_type, payload_digest, payload_bytes, refers_to and
    payload (null for revisits, whose record holds none, and without
    ``with_payload``). payload_bytes of a revisit is null here; see
    ``resolve_revisits``. A damaged archive or a payload that does not have
    its digest fails the job."""
    spark = prepare(manifest)

    def locate(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = file_system(path)
                with fs.open_input_file(name) as f:
                    runs = list(record_runs(f, f.size(), run_bytes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(runs)), pa.array([r[0] for r in runs], pa.int64()),
                     pa.array([r[1] for r in runs], pa.list_(pa.int64()))], ["path", "at", "lengths"])

    def read(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                            ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path, at, lengths in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                fs, name = file_system(path)
                with fs.open_input_file(name) as f:
                    data = _at(f, at, sum(lengths))
                rows, x = [], 0
                for n in lengths:
                    fields, payload = parse_record(data[x:x + n])
                    x += n
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = fields["warc-type"]
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"{path}: a payload does not have its digest")
                    whole = kind == "response"
                    rows.append((int(fields["x-page-id"]) if "x-page-id" in fields else None, fields.get("warc-target-uri"),
                                 kind, digest, len(payload) if whole else None,
                                 int(fields["x-refers-to-page-id"]) if "x-refers-to-page-id" in fields else None,
                                 payload if whole and with_payload else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    runs = manifest.select("path").repartition(shuffle_partitions(spark)).mapInArrow(
        locate, "path string, at long, lengths array<long>")
    return runs.repartition(shuffle_partitions(spark)).mapInArrow(
        read, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
              "refers_to long, payload binary")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with payload_bytes of revisits taken from the response that
    they refer to (one row a digest, so no row is multiplied). The records are
    stored once, so that no archive is read again for it."""
    n = free_name(records, "_bytes")
    records = stored(records, "warc-records")
    asked = records.filter("record_type <> 'response'").select("payload_digest").distinct()
    sizes = (records.filter("record_type = 'response'").join(asked, "payload_digest", "left_semi")
             .groupBy("payload_digest").agg(F.max("payload_bytes").alias(n)))
    revisits = records.filter("record_type <> 'response'").join(sizes.hint("merge"), "payload_digest", "left")
    whole = records.filter("record_type = 'response' or record_type is null")
    return whole.unionByName(revisits.withColumn("payload_bytes", F.coalesce("payload_bytes", n)).select(records.columns))
