"""WARC records in ZIP archives: writing, and reading by range without extraction.

Writing. Every row becomes one WARC record. Of records with equal payloads of at
least `revisit_from` bytes, the one with the smallest id is a response and the
others are revisits that refer to it; smaller payloads are all responses.
Records are dealt into archives of about `archive_bytes`. Each archive is a ZIP
file with two stored (not compressed) members: `records.warc`, and `index.cdx`
with a line per record: its place in the first member, length, digest, type and
target. ZIP64 fields are written where sizes or places need them.

Reading. The end-of-archive record (and ZIP64's) gives the central directory,
that gives the stored members, and the index gives the records. All are read
by range. Record ranges then go to as many tasks as there are batches, so one
large archive is not one task's work. Each record's header, length and digest
are checked.

Files are reached through Arrow's file systems, by URI, so the folder may be a
local mount or an object store. A task writes under a name of its own attempt
and returns it; only returned names are read, so a repeated task does no harm.

Null html counts as empty. Rows that share an id and a payload: one of them is
the response, the others revisit it by that id. A null id sorts last, and is
read back as null: a record's own identifier is made of the id, if there is one,
and of the row's place, so rows that share an id have records of their own. An
empty table gives no archives and no records. A long payload is one record; a
task holds one of them and a few megabytes more. Only the three named columns
are read, so others may clash.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import struct
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import shared_dir, slices, written

RECORDS, INDEX = "records.warc", "index.cdx"
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR = (b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07")
_BIG = 0xFFFFFFFF


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(ident: str | None, place: int) -> str:
    """The record's identifier: the row's place, after its id if it has one."""
    return f"<urn:place:{place}>" if ident is None else f"<urn:page:{quote(ident, safe='')}:{place}>"


def page_of(identifier: str) -> str | None:
    """The row's id in a record's identifier."""
    _, kind, rest = identifier.strip("<>").split(":", 2)
    return unquote(rest.rsplit(":", 1)[0]) if kind == "page" else None


def record(kind: str, identifier: str, date: str, uri: str, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; it names the digest and the record that has."""
    body = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {identifier}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8"]
    if refers is not None:
        lines += [f"WARC-Refers-To: {refers}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*(" ".join(x.split("\n")).replace("\r", " ") for x in lines), f"Content-Length: {len(body)}"])
    return head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class ZipWriter:
    """Stored members, written in one pass: sizes and sums follow each member."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)  # ZIP64: the descriptor has eight-byte sizes
        self._write(_LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 0x21, 0, _BIG, _BIG, len(self.name), len(extra))
                    + self.name + extra)

    def add(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._write(data)

    def end(self) -> None:
        self._write(b"PK\x07\x08" + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.start))

    def close(self) -> None:
        start = self.at
        for name, crc, size, at in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at)
            self._write(_CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 0x21, crc, _BIG, _BIG,
                                               len(name), len(extra), 0, 0, 0, 0, _BIG) + name + extra)
        length, end64 = self.at - start, self.at
        n = len(self.members)
        self._write(_END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, length, start))
        self._write(_LOCATOR + struct.pack("<IQI", 0, end64, 1))
        self._write(_END + struct.pack("<HHHHIIH", 0, 0, n, n, min(length, _BIG), _BIG, 0))


def directory(read, size: int) -> dict[str, tuple[int, int, int]]:
    """Stored members of a ZIP file: name -> (place of the data, length, crc32).

    `read(at, length)` reads a range. ZIP64 records and extra fields are followed.
    """
    tail_at = max(0, size - 22 - 0xFFFF - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END, 0, len(tail) - 18)
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == _LOCATOR:
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != _END64:
            raise ValueError("ZIP64 locator leads to no ZIP64 record")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    entries, data, at = {}, read(start, length), 0
    for _ in range(count):
        if data[at:at + 4] != _CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, plain, n, m, k = struct.unpack_from("<IIIHHH", data, at + 16)
        place, = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = data[at + 46 + n:at + 46 + n + m], 0
        while x + 4 <= len(extra):
            tag, wide = struct.unpack_from("<HH", extra, x)
            if tag == 1:  # eight-byte values, only for the fields that are full
                values = iter(struct.unpack_from(f"<{wide // 8}Q", extra, x + 4))
                plain = next(values) if plain == _BIG else plain
                packed = next(values) if packed == _BIG else packed
                place = next(values) if place == _BIG else place
            x += 4 + wide
        if method == 0:
            local = read(place, 30)
            if local[:4] != _LOCAL:
                raise ValueError("damaged member header")
            a, b = struct.unpack_from("<HH", local, 26)
            entries[name] = (place + 30 + a + b, plain, crc)
        at += 46 + n + m + k
    return entries


def plan(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
         revisit_from: int = 0) -> DataFrame:
    """Each row with its digest, length, record type and the id that it refers to.

    Only digests meet in the shuffle: the smallest id per digest is aggregated
    before it, then joined back, so payloads stay where they are.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("bytes", F.length("payload").cast("long"))
    return rows.withColumn("shared", F.col("bytes") >= revisit_from)


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", payload_col: str = "html",
          url_col: str = "url", revisit_from: int = 0, archive_bytes: int = 64 << 20,
          date: dt.datetime | None = None) -> tuple[DataFrame, str]:
    """Write the archives; returns (uri, bytes, records) of each, as a written table, and the folder.

    The records' date is `date`, or the time of this call, in UTC.
    `pages` must be a table, or be written first: its rows are numbered by their
    place, once for the digests and once for the payloads.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "archives")
    moment = (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = plan(pages, id_col, payload_col, url_col, revisit_from)
    slim = written(rows.select("id", "place", "sha", "bytes", "shared"), "warc_digests")
    first = slim.where("shared").groupBy("sha").agg(F.min(F.struct(F.col("id").isNull(), "id", "place")).alias("first"),
                                                    F.count("*").alias("times")).where("times > 1")
    # Digests that occur once need no word to their records; the rest are the copies' own rows.
    kinds = slim.where("shared").join(first, "sha").where("place <> first.place").select(
        "place", F.col("first.id").alias("refers"), F.col("first.place").alias("refers_place"))
    kinds = written(kinds, "warc_revisits")
    if kinds.count() <= 1_000_000:
        kinds = F.broadcast(kinds)
    kinds = kinds.withColumn("revisit", F.lit(True))
    ready = rows.select("id", "url", "payload", "place").join(kinds, "place", "left")

    def run(batches):
        out = zip_ = None
        index: list[str] = []
        filesystem, root = file_system(folder)
        filesystem.create_dir(root, recursive=True)

        def close():
            zip_.end()
            zip_.begin(INDEX)
            zip_.add("".join(index).encode())
            zip_.end()
            zip_.close()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([zip_.at], pa.int64()), pa.array([len(index)], pa.int64())],
                                              names=["uri", "bytes", "records"])

        for batch in slices(batches, 2):
            for ident, url, payload, place, refers, refers_place, revisit in zip(
                    *(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.zip"
                    out = filesystem.open_output_stream(f"{root}/{name.rsplit('/', 1)[1]}")
                    zip_, index = ZipWriter(out), []
                    zip_.begin(RECORDS)
                kind = "revisit" if revisit else "response"
                digest = digest_of(payload)
                named = record_id(None if ident is None else str(ident), place)
                first = record_id(None if refers is None else str(refers), refers_place) if revisit else None
                data = record(kind, named, moment, url or "", payload, digest, first)
                index.append(f"{zip_.size} {len(data)} {kind} {digest}\n")
                zip_.add(data)
                if zip_.size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    made = ready.select("id", "url", "payload", "place", "refers", "refers_place", "revisit").mapInArrow(run, "uri string, bytes long, records long")
    return written(made, "warc_archives"), folder


def _reader(uri: str):
    filesystem, path = file_system(uri)
    source = filesystem.open_input_file(path)

    def read(at: int, length: int) -> bytes:
        data = source.read_at(length, at)
        if len(data) != length:
            raise ValueError(f"{uri} ends early")
        return data

    return source, read


def ranges(archives: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """Batches of neighbouring records, from the indexes: uri, at, length (of the
    range) and the records' own lengths."""
    def run(batches):
        for batch in batches:
            for uri, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, read = _reader(uri)
                with source:
                    members = directory(read, size)
                    start, _, _ = members[RECORDS]
                    at, length, crc = members[INDEX]
                    index = read(at, length)
                if zlib.crc32(index) != crc:
                    raise ValueError(f"damaged index in {uri}")
                rows: list[tuple] = []
                for line in index.decode().splitlines():
                    place, length = map(int, line.split()[:2])
                    if not rows or place - rows[-1][1] >= batch_bytes:
                        rows.append((uri, place, []))
                    rows[-1][2].append(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([start + r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["uri", "at", "lengths"])

    return archives.select("uri", "bytes").mapInArrow(run, "uri string, at long, lengths array<long>")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    return fields, rest[:length]


def read(archives: DataFrame) -> DataFrame:
    """The records of all archives: id, url, payload_bytes, payload_digest, record_type, refers_to, block."""
    batches_ = written(ranges(archives), "warc_ranges")
    parts = max(1, min(batches_.count(), 100_000))
    fields = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, block binary"

    def run(batches):
        for batch in batches:
            for uri, at, lengths in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                source, read = _reader(uri)
                with source:
                    data = memoryview(read(at, sum(lengths)))
                rows, done = [], 0
                for length in lengths:
                    head, block = parse(bytes(data[done:done + length]))
                    done += length
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response" and digest_of(block) != digest:
                        raise ValueError(f"digest of a record in {uri} differs")
                    name = lambda k: page_of(head[k]) if k in head else None  # noqa: B023, E731
                    rows.append((name("warc-record-id"), head["warc-target-uri"], int(head["x-payload-length"]), digest,
                                 head["warc-type"], name("warc-refers-to"), block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.binary() if k == 6 else pa.int64() if k == 2 else pa.string())
                     for k, column in enumerate(zip(*rows, strict=True))], names=[f.split()[0] for f in fields.split(", ")])

    return batches_.repartition(parts).mapInArrow(run, fields)
