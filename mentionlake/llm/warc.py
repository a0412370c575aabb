"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.session import materialise, scratch_path, ship_package

#: Fixed values of the format.
VERSION = b"WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")

DATE = "2024-01-01T00:00:00Z"
#: A file is closed beyond this size; its dictionary is trained on its first records, so both are bounded.
FILE_BYTES = 64 << 20
SAMPLE_BYTES, SAMPLE_RECORDS, DICTIONARY_BYTES = 1 << 20, 256, 16 << 10
READ_BYTES = 1 << 20

MANIFEST = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
])
ARROW_RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


class ArchiveError(ValueError):
    """An archive or a record that breaks the format."""


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder as Spark names it, and the path in it."""
    scheme = urlsplit(uri).scheme
    if not scheme or scheme == "file":
        return pafs.LocalFileSystem(), urlsplit(uri).path
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: bytes) -> int | None:
    text = value.decode("ascii")
    if not (text.startswith("<urn:page:") and text.endswith(">")):
        raise ArchiveError(f"no page in record id {text}")
    return int(text[10:-1]) if text[10:-1] else None


def build(page_id, url, payload: bytes | None, size: int, digest: str, kind: str, refers_to) -> bytes:
    """One record. A revisit keeps the HTTP headers of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode("ascii")
    block = http + (payload or b"")
    lines = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(block: bytes) -> dict[bytes, bytes]:
    found = {}
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ArchiveError(f"bad header line {line[:80]!r}")
        found[name.strip().lower()] = value.strip()
    return found


def number(found: dict[bytes, bytes], name: bytes) -> int:
    value = found.get(name, b"")
    if not value.isdigit():
        raise ArchiveError(f"bad {name.decode()}: {value[:40]!r}")
    return int(value)


def parse(record: bytes) -> dict:
    """Take a record apart and check its version, headers, lengths and digests."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or version != VERSION:
        raise ArchiveError(f"no WARC header: {record[:40]!r}")
    found = headers(lines)
    if missing := [name.decode() for name in REQUIRED if not found.get(name)]:
        raise ArchiveError(f"headers missing: {missing}")
    length = number(found, b"content-length")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"block of {len(rest) - 4} bytes, {length} announced")
    block = rest[:length]
    if found.get(b"warc-block-digest", b"").decode() != "sha1:" + base32(hashlib.sha1(block).digest()):
        raise ArchiveError("block digest differs")
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ArchiveError("no HTTP header in the block")
    size = number(headers(http.partition(b"\r\n")[2]), b"content-length")
    kind = found[b"warc-type"].decode()
    digest = found.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
    refers_to = None
    if kind == "response":
        if size != len(payload) or digest != base32(hashlib.sha1(payload).digest()):
            raise ArchiveError("payload differs from its length or digest")
    elif kind == "revisit":
        if payload or found.get(b"warc-profile", b"").decode() != REVISIT_PROFILE or b"warc-refers-to" not in found:
            raise ArchiveError("revisit with a payload, another profile or no reference")
        refers_to = page_of(found[b"warc-refers-to"])
    else:
        raise ArchiveError(f"record type {kind}")
    return {
        "page_id": page_of(found[b"warc-record-id"]), "url": found[b"warc-target-uri"].decode() if b"warc-target-uri" in found else None,
        "record_type": kind, "refers_to": refers_to, "payload_bytes": size, "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def train(samples: list[bytes]) -> bytes | None:
    """A dictionary of some records, or none where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return None


class Writer:
    """Writes files of one task. Names are new in every attempt; only those of the attempt that
    succeeds reach the manifest, so files of lost executors are never read."""

    def __init__(self, folder: str) -> None:
        self.folder, self.done, self.sink = folder, [], None
        self.waiting: list[bytes] = []
        self.fs, self.root = file_system(folder)
        self.fs.create_dir(self.root, recursive=True)

    def add(self, record: bytes) -> None:
        if self.sink is not None:
            self._write(record)
            return
        self.waiting.append(record)
        if len(self.waiting) >= SAMPLE_RECORDS or sum(map(len, self.waiting)) >= SAMPLE_BYTES:
            self._open()

    def _open(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.sink = self.fs.open_output_stream(f"{self.root}/{self.name}")
        self.records = self.bytes = 0
        samples = [r[:SAMPLE_BYTES] for r in self.waiting]
        dictionary = train(samples)
        data = None
        if dictionary:
            frame = zstandard.ZstdCompressor().compress(dictionary)
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(frame)) + frame)
            data = zstandard.ZstdCompressionDict(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=True, write_content_size=True)
        waiting, self.waiting = self.waiting, []
        for record in waiting:
            self._write(record)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def _write(self, record: bytes) -> None:
        if self.sink is None:
            self.waiting.append(record)
            return
        self._put(self.compressor.compress(record))
        self.records += 1
        if self.bytes >= FILE_BYTES:
            self.close_file()

    def close_file(self) -> None:
        self.sink.close()
        self.done.append((f"{self.folder}/{self.name}", self.records, self.bytes))
        self.sink = None

    def close(self) -> list[tuple[str, int, int]]:
        while self.sink is not None or self.waiting:
            if self.sink is None:
                self._open()
            if self.sink is not None:
                self.close_file()
        return self.done


def _write_task(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder)
        for batch in batches:
            for row in batch.to_pylist():
                digest = base32(bytes.fromhex(row["sha1"]))
                writer.add(build(row["page_id"], row["url"], row["payload"], row["payload_bytes"], digest, row["record_type"], row["refers_to"]))
        done = writer.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=MANIFEST.names)

    return run


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, one frame each, with what is needed of the file in memory only."""
    data = b""

    def more(n: int) -> bytes:
        nonlocal data
        while len(data) < n:
            chunk = stream.read(READ_BYTES)
            if not chunk:
                break
            data += chunk
        return data

    dictionary, first = None, True
    while more(4):
        magic = int.from_bytes(data[:4], "little")
        if magic in SKIPPABLE:
            if len(more(8)) < 8:
                raise ArchiveError("skippable frame ends early")
            size = int.from_bytes(data[4:8], "little")
            if len(more(8 + size)) < 8 + size:
                raise ArchiveError("skippable frame ends early")
            content, data = data[8 : 8 + size], data[8 + size :]
            if magic == DICTIONARY_MAGIC and first:
                plain = zstandard.ZstdDecompressor().decompressobj().decompress(content) if content[:4] == FRAME_MAGIC else content
                dictionary = zstandard.ZstdCompressionDict(plain)
            first = False
            continue
        first = False
        if data[:4] != FRAME_MAGIC:
            raise ArchiveError(f"no frame begins with {data[:4]!r}")
        frame, parts = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), []
        while not frame.eof:
            chunk = data or stream.read(READ_BYTES)
            if not chunk:
                raise ArchiveError("frame ends early")
            parts.append(frame.decompress(chunk))
            data = frame.unused_data
        yield b"".join(parts)


def read_archive(path: str) -> Iterator[dict]:
    fs, name = file_system(path)
    with fs.open_input_stream(name) as stream:
        for record in frames(stream):
            yield parse(record)


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            seen, rows, size = 0, [], 0
            for record in read_archive(row["path"]):
                rows.append(record)
                seen, size = seen + 1, size + len(record["payload"] or b"")
                if size >= 8 * READ_BYTES or len(rows) >= 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW_RECORD)
                    rows, size = [], 0
            if seen != row["records"]:
                raise ArchiveError(f"{row['path']}: {seen} records, {row['records']} written")
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=ARROW_RECORD)


def with_revisits(pages: DataFrame, payload: Column) -> DataFrame:
    """Add payload, digest and record type. Of rows with one payload that with the largest id is the response.

    Only digests that occur more than once are looked up, and both sides of that join come from a plain
    scan, so a payload that most pages share can be split.
    """
    full = pages.select("page_id", "url", F.coalesce(payload.cast("binary"), F.lit(b"")).alias("payload"))
    full = full.withColumn("sha1", F.sha1("payload"))
    shared = full.groupBy("sha1").agg(F.max("page_id").alias("__largest"), F.count(F.lit(1)).alias("__n"))
    shared = materialise(shared.where("__n > 1").select("sha1", "__largest"), "warc-shared")
    revisit = F.col("__largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__largest"))
    return full.join(shared, "sha1", "left").select(
        "page_id", "url", "sha1", F.length("payload").cast("long").alias("payload_bytes"), F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("__largest")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, payload_col: str = "html") -> DataFrame:
    """Write a record per page (``page_id``, ``url``, payload); returns the manifest (path, records, bytes).

    A null payload is written as an empty one, a null url leaves the header out. Rows that repeat an id and its payload
    are all responses; pages without an id refer to one that has it, if their payload does. An empty
    table writes no file. Further columns are ignored.
    """
    ship_package(pages.sparkSession)
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return materialise(with_revisits(pages, F.col(payload_col)).mapInArrow(_write_task(folder), MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """All records of the files in a manifest; a file that breaks the format, or has lost records, fails the job."""
    ship_package(manifest.sparkSession)
    return manifest.repartition(max(1, manifest.count())).mapInArrow(_read_task, RECORD)
