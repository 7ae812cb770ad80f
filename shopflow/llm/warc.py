"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each of a few records, then a
skippable frame with the record index (record id, frame, offset in the frame, length) and
a skippable frame with the seek table of all frames, whose last bytes find it.  One
record is read by decompressing its frame alone.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, materialise, shared_path
from shopflow.llm.files import read_range, write_file

# fixed values of the seekable format
SEEK_FRAME, SEEK_MAGIC, INDEX_FRAME = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    number = (record or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, date: str, refers_to: int | None = None,
           revisit: bool = False) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head, but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """WARC fields, HTTP fields, payload and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    fields = _fields(data[at:end])
    start, size = end + 4, int(fields["content-length"])
    split = data.index(b"\r\n\r\n", start) + 4
    return fields, _fields(data[start:split - 4]), data[split:start + size], start + size + 4


class BundleWriter:
    """Collects records into frames of about ``frame_bytes``; a longer record has one alone."""

    def __init__(self, frame_bytes: int = 256 << 10, level: int = 3):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.frame_bytes, self.frames, self.seek, self.index = frame_bytes, [], [], []
        self.open, self.open_size, self.size = [], 0, 0

    def add(self, name: str, data: bytes) -> None:
        if self.open and self.open_size + len(data) > self.frame_bytes:
            self._close_frame()
        self.index.append((name, len(self.seek), self.open_size, len(data)))
        self.open.append(data)
        self.open_size += len(data)

    def _close_frame(self) -> None:
        frame = self.compress(b"".join(self.open))
        self.seek.append((len(frame), self.open_size))
        self.frames.append(frame)
        self.size += len(frame)
        self.open, self.open_size = [], 0

    def finish(self) -> bytes:
        if self.open:
            self._close_frame()
        index = self.compress(json.dumps(self.index).encode())
        self.frames.append(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        self.seek.append((len(self.frames[-1]), 0))
        table = b"".join(struct.pack("<II", *entry) for entry in self.seek)
        foot = struct.pack("<IBI", len(self.seek), 0, SEEK_MAGIC)
        return b"".join([*self.frames, struct.pack("<II", SEEK_FRAME, len(table) + len(foot)), table, foot])


class Bundle:
    """Reads a bundle by ranges of its file."""

    def __init__(self, uri: str):
        import zstandard

        self.uri, self.unpack = uri, zstandard.ZstdDecompressor().decompress
        count, _, magic = struct.unpack("<IBI", read_range(uri, -9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"no seek table: {uri}")
        entries = np.frombuffer(read_range(uri, -9 - 8 * count, 8 * count), "<u4").reshape(-1, 2).astype(np.int64)
        self.sizes, self.starts = entries, np.cumsum(entries[:, 0]) - entries[:, 0]

    def __len__(self) -> int:
        return len(self.sizes) - 1

    def frame(self, k: int) -> bytes:
        return self.unpack(read_range(self.uri, int(self.starts[k]), int(self.sizes[k, 0])))

    def index(self) -> dict[str, tuple[int, int, int]]:
        """Record id to frame, offset in the frame and length (of repeated ids the last)."""
        raw = read_range(self.uri, int(self.starts[-1]) + 8, int(self.sizes[-1, 0]) - 8)
        return {name: (k, at, n) for name, k, at, n in json.loads(self.unpack(raw))}

    def record(self, name: str) -> bytes:
        k, at, n = self.index()[name]
        return self.frame(k)[at:at + n]

    def records(self) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
        for k in range(len(self)):
            data, at = self.frame(k), 0
            while at < len(data):
                fields, http, payload, at = parse(data, at)
                yield fields, http, payload


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", revisit_bytes: int = 0, bundle_bytes: int = 32 << 20,
                  date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every page as a record; returns the manifest (bundle path, records).

    The payload is the html in UTF-8 (null: empty).  Of equal payloads of at least ``revisit_bytes``
    bytes, the smallest page id is a response, the others revisit it.  Rows that repeat the
    smallest id are responses too; null ids revisit where the payload has an id, and are
    responses where it has none.  Null urls have no target.  Other columns are ignored.
    A file counts once the manifest names it.
    """
    payload = F.coalesce(col(html_col), F.lit("")).cast("binary")
    rows = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"),
                        payload.alias("payload")).withColumn("key", F.sha1("payload"))
    groups = materialise(
        rows.filter(F.octet_length("payload") >= revisit_bytes).groupBy("key")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL").select("key", "first"), "payloads")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (
        F.octet_length("payload") >= revisit_bytes)
    named = rows.join(groups, "key", "left").select(
        "page_id", "url", "payload", F.when(again, F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, size = BundleWriter(), 0

        def flush() -> pa.RecordBatch:
            uri = f"{path}/{uuid.uuid4().hex}.warc.zst"
            write_file(uri, bundle.finish())
            return pa.RecordBatch.from_pydict({"path": [uri], "records": [len(bundle.index)]})

        for batch in batches:
            for i in range(len(batch)):
                page, url, body, refers_to = (c[i].as_py() for c in batch.columns)
                data = record(page, url, body, date, refers_to, refers_to is not None)
                bundle.add(record_id(page), data)
                size += len(data)
                if size >= bundle_bytes:
                    yield flush()
                    bundle, size = BundleWriter(), 0
        if bundle.index:
            yield flush()

    return materialise(named.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_bundles(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record.

    Size and digest of a response are taken from its payload, which must agree with its head.
    """
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c.split()[0] for c in PAGE.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                out = []
                for fields, http, payload in Bundle(uri).records():
                    kind, declared = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                    size = int(http["content-length"])
                    if kind == "response" and (digest(payload), len(payload)) != (declared, size):
                        raise ValueError(f"damaged record {fields['warc-record-id']} in {uri}")
                    out.append((page_of(fields["warc-record-id"]), size, declared, kind,
                                page_of(fields.get("warc-refers-to"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return manifest.select("path").repartition(parts, "path").mapInArrow(read, PAGE)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write the bundles of ``pages`` to a fresh shared folder and read them back."""
    path = shared_path(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, path, **options))
