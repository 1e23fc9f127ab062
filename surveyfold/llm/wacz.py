"""WARC records in ZIP-packaged web archives: writer and range reader.

An archive is a ZIP file whose members are stored, not deflated, so that a
record can be read by its byte range without extracting anything:

    archive/data.warc.gz   WARC records, one gzip member each
    indexes/index.cdxj     one line per record: key, then JSON with the
                           record's offset and length inside data.warc.gz
    datapackage.json       member names and sizes

The reader finds the end record from the tail of the file, follows the ZIP64
locator where there is one, parses the central directory, resolves each stored
member's data offset from its local header, reads the index member and then
each record by one range read.

Archives are written by tasks straight into the shared folder, each under a
name no other attempt uses, and are listed in a manifest table that Spark
commits; a lost or repeated attempt leaves a file that no manifest names.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, stage_table
from .common import bound_batches, shuffle_partitions, tidy

# fixed values: record layouts and signatures of the ZIP and ZIP64 formats
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
STORED = 0
END_SIZE, LOCATOR_SIZE, COMMENT_MAX = 22, 20, 0xFFFF

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
MANIFEST_SCHEMA = "path string, records long, bytes long"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a URI; a bare path is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a full URI, by the file system that Spark finds it on: a
    path without a scheme is on ``fs.defaultFS``, not on a task's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(path).toUri().toString()


# --- ZIP -------------------------------------------------------------------

class Member(NamedTuple):
    name: str
    method: int
    size: int
    header_offset: int


class StoredZipWriter:
    """Appends stored members to a stream; sizes and offsets go to ZIP64 fields
    where they need to, or always with ``force64``."""

    def __init__(self, out, force64: bool = False):
        self.out, self.pos, self.force64, self.entries = out, 0, force64, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.pos += len(data)

    def add(self, name: str, chunks: list[bytes]) -> None:
        size, crc = sum(map(len, chunks)), 0
        for c in chunks:
            crc = zlib.crc32(c, crc)
        raw, start = name.encode(), self.pos
        big = self.force64 or size >= MAX32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        short = MAX32 if big else size
        self._put(struct.pack("<4sHHHHHIIIHH", LOCAL, 45 if big else 20, 0x800, STORED, 0, 0x21,
                              crc, short, short, len(raw), len(extra)) + raw + extra)
        for c in chunks:
            self._put(c)
        self.entries.append((raw, crc, size, start))

    def close(self) -> None:
        begin = self.pos
        for raw, crc, size, start in self.entries:
            wide = []
            if self.force64 or size >= MAX32:
                wide += [size, size]
            if self.force64 or start >= MAX32:
                wide.append(start)
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            short = MAX32 if self.force64 or size >= MAX32 else size
            self._put(struct.pack(
                "<4sHHHHHHIIIHHHHHII", CENTRAL, 45, 45 if wide else 20, 0x800, STORED, 0, 0x21, crc,
                short, short, len(raw), len(extra), 0, 0, 0, 0,
                MAX32 if self.force64 or start >= MAX32 else start) + raw + extra)
        length, count = self.pos - begin, len(self.entries)
        if self.force64 or begin >= MAX32 or length >= MAX32 or count >= MAX16:
            at = self.pos
            self._put(struct.pack("<4sQHHIIQQQQ", END64, 44, 45, 45, 0, 0, count, count, length, begin))
            self._put(struct.pack("<4sIQI", LOCATOR64, 0, at, 1))
            count, length, begin = MAX16, MAX32, MAX32
        self._put(struct.pack("<4sHHHHIIH", END, 0, 0, count, count, length, begin, 0))


def central_directory(f, size: int) -> dict[str, Member]:
    """Members by name, read from the central directory of an open file."""
    tail_at = max(0, size - END_SIZE - COMMENT_MAX)
    tail = f.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    _, _, _, _, count, length, begin, _ = struct.unpack("<4sHHHHIIH", tail[at:at + END_SIZE])
    if MAX16 == count or MAX32 in (length, begin):
        loc = f.read_at(LOCATOR_SIZE, tail_at + at - LOCATOR_SIZE)
        sign, _, at64, _ = struct.unpack("<4sIQI", loc)
        if sign == LOCATOR64:
            sign, _, _, _, _, _, _, count, length, begin = struct.unpack(
                "<4sQHHIIQQQQ", f.read_at(56, at64))
            if sign != END64:
                raise ValueError("broken ZIP64 end record")
    directory, pos, members = f.read_at(length, begin), 0, {}
    for _ in range(count):
        (sign, _, _, _, method, _, _, _, packed, size_, n_name, n_extra, n_comment, _, _, _,
         offset) = struct.unpack("<4sHHHHHHIIIHHHHHII", directory[pos:pos + 46])
        if sign != CENTRAL:
            raise ValueError("broken central directory")
        name = directory[pos + 46:pos + 46 + n_name].decode()
        extra = directory[pos + 46 + n_name:pos + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4:4 + n // 8 * 8]))
                size_ = wide.pop(0) if size_ == MAX32 else size_
                packed = wide.pop(0) if packed == MAX32 else packed
                offset = wide.pop(0) if offset == MAX32 else offset
            extra = extra[4 + n:]
        members[name] = Member(name, method, size_, offset)
        pos += 46 + n_name + n_extra + n_comment
    return members


def data_offset(f, m: Member) -> int:
    """Where a stored member's bytes begin."""
    if m.method != STORED:
        raise ValueError(f"{m.name} is deflated, so it has no byte ranges")
    sign, *_, n_name, n_extra = struct.unpack("<4sHHHHHIIIHH", f.read_at(30, m.header_offset))
    if sign != LOCAL:
        raise ValueError(f"no local header for {m.name}")
    return m.header_offset + 30 + n_name + n_extra


# --- WARC ------------------------------------------------------------------

def _header_value(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record. A revisit carries the HTTP header block only; its
    Content-Length there is that of the full payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {quote(str(page_id), safe='')}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {quote(str(refers_to), safe='')}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    page_id: str | None
    url: str | None
    kind: str
    refers_to: str | None
    digest: str
    payload_bytes: int
    payload: bytes | None


def parse_record(data: bytes) -> Record:
    """The record, its digest recomputed from the payload where it has one."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of page {fields.get('X-Page-ID')} is damaged")
    told = lambda k: unquote(fields[k]) if k in fields else None
    return Record(told("X-Page-ID"), fields.get("WARC-Target-URI"), kind,
                  told("X-Refers-To-Page-ID"), digest, length,
                  payload if kind == "response" else None)


def _gzip_member(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archive(fs: pafs.FileSystem, path: str, records: list[bytes], index: list[str],
                  force64: bool = False) -> int:
    with fs.open_output_stream(path) as out:
        z = StoredZipWriter(out, force64)
        z.add(WARC_MEMBER, records)
        z.add(INDEX_MEMBER, ["".join(sorted(index)).encode()])
        z.add("datapackage.json", [json.dumps({"profile": "data-package", "resources": [
            {"path": WARC_MEMBER, "bytes": sum(map(len, records))},
            {"path": INDEX_MEMBER, "records": len(index)}]}).encode()])
        z.close()
    return z.pos


def read_archive(fs: pafs.FileSystem, path: str) -> Iterator[Record]:
    """Every record of an archive, in index order, one range read each."""
    with fs.open_input_file(path) as f:
        members = central_directory(f, f.size())
        index = members[INDEX_MEMBER]
        base = data_offset(f, members[WARC_MEMBER])
        lines = f.read_at(index.size, data_offset(f, index)).decode()
        for line in filter(None, lines.split("\n")):
            entry = json.loads(line.split(" ", 1)[1])
            raw = f.read_at(entry["length"], base + entry["offset"])
            yield parse_record(zlib.decompress(raw, 31))


# --- on Spark --------------------------------------------------------------

def classified(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """page_id, url, html, digest, record_type, refers_to for every row.

    Only payloads of at least ``min_bytes`` that occur more than once take
    part in the join; the table of their first pages is written down, so the
    join exchanges both sides and adaptive skew join can split a payload that
    very many pages share.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    firsts = stage_table(
        base.filter(F.octet_length("html") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1").select(F.col("digest").alias("seen"), "first_id"), "warc-firsts")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (base.join(firsts, F.col("digest") == F.col("seen"), "left")
            .select("page_id", "url", "html", "digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first_id")).alias("refers_to")))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 16 << 20,
                   level: int = 6, force64: bool = False) -> DataFrame:
    """Write the classified rows as archives of about ``archive_bytes``; the manifest."""

    @tidy
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        done, parts, index, pos = [], [], [], 0

        def flush():
            nonlocal parts, index, pos
            name = f"{base}/{uuid.uuid4().hex}.wacz"
            done.append((name, len(index), write_archive(fs, name, parts, index, force64)))
            parts, index, pos = [], [], 0

        for frame in batches:
            for page, url, html, digest, kind, refers in zip(
                    frame.page_id, frame.url, frame.html, frame.digest, frame.record_type,
                    frame.refers_to, strict=True):
                page, refers = (x if isinstance(x, str) else None for x in (page, refers))
                part = _gzip_member(record_bytes(page, url if isinstance(url, str) else None,
                                                 html.encode(), digest, kind, refers), level)
                index.append(f"{'-' if page is None else quote(page, safe='').zfill(20)} " + json.dumps(
                    {"offset": pos, "length": len(part), "digest": digest}) + "\n")
                parts.append(part)
                pos += len(part)
                if pos >= archive_bytes:
                    flush()
        if parts:
            flush()
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    bound_batches(records.sparkSession)
    folder = qualified(records.sparkSession, folder)
    # ids as text: of any type, and pandas would turn numbers with a null into floats
    return records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}) \
        .mapInPandas(write, MANIFEST_SCHEMA)


RECORD_SCHEMA = ("page_id string, url string, record_type string, refers_to string, "
                 "payload_digest string, payload_bytes long, payload binary")


def read_archives(manifest: DataFrame, folder: str, payload: bool = True, id_type: str = "long") -> DataFrame:
    """Records of the archives that the manifest names, one archive at a time;
    ids, text in an archive, are cast to ``id_type``."""
    folder = qualified(manifest.sparkSession, folder)

    @tidy
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = open_fs(folder)
        columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

        def frame(rows):
            return pd.DataFrame(rows, columns=columns).astype({"payload_bytes": "int64"})

        for f in batches:
            for path in f.path:
                rows, held = [], 0
                for r in read_archive(fs, path):
                    rows.append((r.page_id, r.url, r.kind, r.refers_to, r.digest, r.payload_bytes,
                                 r.payload if payload else None))
                    held += len(r.payload or b"") if payload else 100
                    if held > 4 << 20:
                        yield frame(rows)
                        rows, held = [], 0
                yield frame(rows)

    # a fixed number of tasks: the manifest is small, and adaptive coalescing
    # would put all archives into one
    tasks = shuffle_partitions(manifest.sparkSession)
    out = manifest.repartition(tasks, "path").mapInPandas(read, RECORD_SCHEMA)
    return out.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, min_bytes: int = 100, force64: bool = False) -> DataFrame:
    """Write one record per page, read the archives back, return the records.

    A null html is an empty payload, a null url leaves the target URI out. Of
    equal payloads of ``min_bytes`` or more the rows with the smallest page_id
    are responses (all of them, where that id repeats) and the others revisit
    it; a null page_id never is the smallest unless all are null, and then all
    are responses. Ids are of any type that a cast to text and back keeps. An
    empty table gives no archive and no rows.
    """
    spark = pages.sparkSession
    folder = os.path.join(checkpoint_root(spark), f"warc-{uuid.uuid4().hex}")
    manifest = stage_table(write_archives(classified(pages, min_bytes), folder, force64=force64),
                           "warc-manifest")
    return read_archives(manifest, folder, payload=False, id_type=pages.schema["page_id"].dataType.simpleString())
