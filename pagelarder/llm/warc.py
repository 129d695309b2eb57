"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some records, and a seek table in
a skippable frame at its end (the public Zstandard seekable format), so any tool that reads
Zstandard can unpack it whole, and a reader of one record decompresses one frame. The index maps
a record to its bundle, its frame and its offset within the decompressed frame.

Of records with equal payloads one is a response; the others are revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelarder.llm.common import shared_folder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 1 << 26, 3
REVISIT_BYTES = 100
# Fixed values of the formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id long, bundle string, frame int, frame_start long, frame_bytes long, "
    "record_start long, record_bytes long"
)
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, payload string"
)


def record_id(page_id: int | None, extra: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"no page:{extra}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _header(value: str) -> str:
    """A header value without characters that end a line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to, date: str) -> bytes:
    """One record. A revisit has no payload but the headers that describe it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, '')}",
            f"WARC-Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(frame: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record of a decompressed frame from an offset on."""
    while at < len(frame):
        stop = frame.index(b"\r\n\r\n", at)
        lines = frame[at:stop].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if lines[0] != "WARC/1.1" or frame[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"no record at {at}")
        yield at, headers, frame[stop + 4 : stop + 4 + size]
        at = stop + 8 + size


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """start, compressed and decompressed bytes of each frame, from the end of an open bundle."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    found, at = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * count)):
        found.append((at, packed, plain))
        at += packed
    return found


class _Bundle:
    def __init__(self, folder: str):
        # Every attempt of a task has files of its own, and the index names those of the one
        # that counted; so retries and speculative copies can't mix.
        system, path = fs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        system.create_dir(path, recursive=True)
        self.file = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.size = 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.open: list[tuple] = []
        self.parts: list[bytes] = []
        self.filled = 0

    def add(self, page_id, data: bytes) -> Iterator[tuple]:
        self.open.append((page_id, self.filled, len(data)))
        self.parts.append(data)
        self.filled += len(data)
        if self.filled >= FRAME_BYTES:
            yield from self.end_frame()

    def end_frame(self) -> Iterator[tuple]:
        if not self.parts:
            return
        packed = self.packer.compress(b"".join(self.parts))
        self.file.write(packed)
        for page_id, at, size in self.open:
            yield page_id, self.name, len(self.frames), self.size, len(packed), at, size
        self.frames.append((len(packed), self.filled))
        self.size += len(packed)
        self.open, self.parts, self.filled = [], [], 0

    def close(self) -> None:
        self.file.write(seek_table(self.frames))
        self.file.close()


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
    bundle, rows = None, []

    def flush() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        out = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(out, names=names)

    for batch in batches:
        for page_id, url, html, size, digest, refers_to in zip(*batch.columns, strict=True):
            bundle = bundle or _Bundle(folder)
            html = html.as_py()
            data = record(
                page_id.as_py(), url.as_py(), None if html is None else html.encode(), size.as_py(),
                digest.as_py(), refers_to.as_py(), date,
            )
            rows += bundle.add(page_id.as_py(), data)
            if bundle.size >= BUNDLE_BYTES:
                rows += bundle.end_frame()
                bundle.close()
                bundle = None
        if len(rows) > 5000:
            yield flush()
    if bundle:
        rows += bundle.end_frame()
        bundle.close()
    yield flush()


def write_archive(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of pages (page_id, url, html) below `folder`; returns the index.

    The payload is the html in UTF-8, a null one is empty. Of rows with equal payloads of at
    least 100 bytes the smallest page_id is the response; rows with another or a null page_id are
    revisits. Shorter payloads, and those that only rows without a page_id have, are responses;
    so are all rows that repeat a response's page_id. An empty table writes nothing.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("html"), F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    # Grouped without payloads; a digest that many pages share is combined before the shuffle.
    first = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    first = stored(
        first.where("n > 1 and first is not null").select(F.col("digest").alias("d"), "first"), "repeats"
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.join(first, rows.digest == first.d, "left").withColumn("refers_to", refers)
    rows = rows.select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"),
        "size", "digest", "refers_to",
    )
    index = rows.mapInArrow(lambda batches: _write(batches, folder, date), INDEX)
    return stored(index, "warc-index")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Records at the given places of bundles; a frame is decompressed once."""
    system, path = fs.FileSystem.from_uri(folder)
    unpack = zstandard.ZstdDecompressor()
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        for name, start, size, wanted in zip(*batch.columns, strict=True):
            with system.open_input_file(f"{path}/{name.as_py()}") as file:
                file.seek(start.as_py())
                frame = unpack.decompress(file.read(size.as_py()))
            rows = []
            for at in wanted.as_py():
                _, headers, block = next(records(frame, at))
                http, _, payload = block.partition(b"\r\n\r\n")
                told = int(http.rpartition(b"Content-Length: ")[2])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                kind = headers["WARC-Type"]
                if kind == "response":
                    digest, told = hashlib.sha256(payload).hexdigest(), len(payload)
                page_id, refers_to = (headers.get(k) for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID"))
                rows.append((
                    None if page_id is None else int(page_id), told, digest, kind,
                    None if refers_to is None else int(refers_to), headers.get("WARC-Target-URI"),
                    payload.decode() if kind == "response" else None,
                ))
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Records of the rows of an index (all of it, or those looked up): their headers and payload.

    Size and digest of a response are those of the payload as read, of a revisit as its headers
    tell. Frames are read where they lie, each by one task.
    """
    frames = index.groupBy("bundle", "frame_start", "frame_bytes").agg(
        F.sort_array(F.collect_list("record_start")).alias("wanted")
    )
    frames = frames.select("bundle", "frame_start", "frame_bytes", "wanted")
    # The index is small and the frames are not, so tasks are counted, not merged by its size.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = frames.repartition(tasks, "bundle", "frame_start")
    return frames.mapInArrow(lambda batches: _read(batches, folder), RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write an archive to the shared folder and read all of it back."""
    folder = shared_folder(spark, "warc")
    return read_records(write_archive(pages, folder), folder)
