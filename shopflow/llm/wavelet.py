"""Token-id files: one wavelet matrix per shard.

A file holds the ids of consecutive documents as bit planes, most significant
bit first; each plane orders the ids stably by the bit of the plane above.  With
the running number of ones (rank), the matrix gives single tokens, counts of a
token in a range and the positions of its occurrences without decoding the rest.
The document table, the rank directory of each plane and the planes, cut into frames
of 64 KB, are independent zstandard sections of one file: one access unpacks the directories and one
frame of each plane.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, materialise, running_start, shared_path
from shopflow.llm.files import read_file, write_file
from shopflow.llm.tokens import encoder, ids_crc32, vocabulary_path

MAGIC = b"WAVEMTX1"
_BLOCK = 512  # bits between two stored ranks
_FRAME = 1 << 16  # bytes of a plane in one zstandard frame


def _planes(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    planes = []
    for b in range(bits - 1, -1, -1):
        plane = np.packbits(ids & ids.dtype.type(1 << b) != 0, bitorder="little")
        planes.append(plane)
        if b:  # a packed plane is an Arrow mask as it is
            zero, one = (pa.BooleanArray.from_buffers(pa.bool_(), len(ids), [None, pa.py_buffer(p)])
                         for p in (~plane, plane))
            values = pa.array(ids)
            ids = np.concatenate([values.filter(zero).to_numpy(), values.filter(one).to_numpy()])
    return planes


def _ranks(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and in all."""
    ones = np.bitwise_count(plane).astype("<i8")
    per = np.add.reduceat(ones, np.arange(0, len(ones), _BLOCK // 8)) if len(ones) else np.zeros(1, "<i8")
    return np.concatenate([np.zeros(1, "<i8"), np.cumsum(per)])


def dump(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, level: int = 3) -> bytes:
    """The file of one shard; ``ids`` are the documents' ids one after another."""
    import zstandard

    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    pack = zstandard.ZstdCompressor(level=level).compress
    known = np.array([d is not None for d in doc_ids], np.uint8)
    planes = _planes(ids, bits)
    sections = [known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                np.array(lengths, "<i8").tobytes(), *(_ranks(p).tobytes() for p in planes),
                *(p[at:at + _FRAME].tobytes() for p in planes for at in range(0, len(p), _FRAME))]
    packed = [pack(s) for s in sections]
    head = json.dumps({"documents": len(doc_ids), "tokens": len(ids), "bits": bits,
                       "sections": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *packed])


class WaveletShard:
    """Reads one shard file."""

    def __init__(self, data: bytes):
        import zstandard

        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack_from("<I", data, 8)
        head = json.loads(data[12:12 + size])
        self.n_tokens, self.bits = head["tokens"], head["bits"]
        self._data, self._unpack = data, zstandard.ZstdDecompressor().decompress
        self._starts = np.cumsum([12 + size, *head["sections"]])
        self._frames = -(-(-(-self.n_tokens // 8)) // _FRAME)  # of one plane
        self._open: dict[int, np.ndarray] = {}
        known = np.frombuffer(self._section(0), np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(self._section(1), "<i8"), known)]
        self.lengths = np.frombuffer(self._section(2), "<i8")

    def _section(self, i: int) -> bytes:
        return self._unpack(self._data[self._starts[i]:self._starts[i + 1]])

    def _held(self, i: int, dtype: str) -> np.ndarray:
        """A section that queries come back to, unpacked once."""
        if i not in self._open:
            self._open[i] = np.frombuffer(self._section(i), dtype)
        return self._open[i]

    def _frame(self, k: int, byte: int) -> tuple[np.ndarray, int]:
        """The frame of plane k that holds the byte, and the byte's place in it."""
        return self._held(3 + self.bits + k * self._frames + byte // _FRAME, "u1"), byte % _FRAME

    def _plane(self, k: int) -> np.ndarray:
        first = 3 + self.bits + k * self._frames
        packed = b"".join(self._section(i) for i in range(first, first + self._frames))
        return np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n_tokens, bitorder="little").view(bool)

    def _directory(self, k: int) -> np.ndarray:
        return self._held(3 + k, "<i8")

    def _bit(self, k: int, i: int) -> int:
        frame, byte = self._frame(k, i // 8)
        return int(frame[byte]) >> i % 8 & 1

    def _ones(self, k: int, i: int) -> int:
        """Ones of plane k before position i."""
        block = i // _BLOCK
        before = int(self._directory(k)[block])
        if i % _BLOCK == 0:
            return before
        frame, lo = self._frame(k, block * (_BLOCK // 8))  # a block lies in one frame
        hi = lo + i % _BLOCK // 8
        tail = int(frame[hi]) & ((1 << i % 8) - 1) if i % 8 else 0
        return before + int(np.bitwise_count(frame[lo:hi]).sum()) + tail.bit_count()

    def _zeros_total(self, k: int) -> int:
        return self.n_tokens - int(self._directory(k)[-1])

    def _select(self, k: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) ``bit`` of plane k, by the rank directory."""
        ranks = self._directory(k)
        if not bit:
            ranks = np.minimum(np.arange(len(ranks)) * _BLOCK, self.n_tokens) - ranks
        block = int(np.searchsorted(ranks, j, "right")) - 1
        lo = block * _BLOCK
        frame, at = self._frame(k, lo // 8)
        inside = np.unpackbits(frame[at:at + _BLOCK // 8], bitorder="little")
        return lo + int(np.flatnonzero(inside[:self.n_tokens - lo] == bit)[j - int(ranks[block])])

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for k in range(self.bits):
            bit = self._bit(k, i)
            ones = self._ones(k, i)
            i = self._zeros_total(k) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        for k in range(self.bits):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if token >> (self.bits - 1 - k) & 1:
                lo, hi = self._zeros_total(k) + a, self._zeros_total(k) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``token`` in positions lo to hi (rank)."""
        a, b = self._range(token, lo, self.n_tokens if hi is None else hi)
        return b - a

    def occurrences(self, token: int, lo: int = 0, hi: int | None = None) -> Iterator[int]:
        """Positions of ``token`` in lo to hi, ascending (select)."""
        a, b = self._range(token, lo, self.n_tokens if hi is None else hi)
        for i in range(a, b):
            for k in range(self.bits - 1, -1, -1):
                bit = token >> (self.bits - 1 - k) & 1
                i = self._select(k, bit, i - self._zeros_total(k) if bit else i)
            yield i

    def decode(self) -> np.ndarray:
        """All ids, undoing the planes from the last to the first."""
        dtype = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.n_tokens, dtype)
        for k in range(self.bits - 1, -1, -1):
            one = self._plane(k)
            zeros = self.n_tokens - int(np.count_nonzero(one))
            above = np.empty_like(ids)
            # positions, as numpy's masks are slow where zeros and ones mix
            above[np.flatnonzero(~one)] = ids[:zeros]
            above[np.flatnonzero(one)] = ids[zeros:] | dtype(1 << (self.bits - 1 - k))
            ids = above
        return ids


def partitions_for(size: int, parallelism: int, bytes_per_partition: int = 128 << 20,
                   least_bytes: int = 1 << 20) -> int:
    """Range partitions for ``size`` bytes of text: 128 MB each, or smaller ones (not below 1 MB)
    while there are fewer than ``parallelism``."""
    return max(1, -(-size // bytes_per_partition), min(parallelism, -(-size // least_bytes)))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 1, bytes_per_partition: int = 128 << 20,
                 tokens_per_shard: int = 4 << 20) -> DataFrame:
    """Encode every text and write one wavelet matrix file per shard, in id order.

    Range partitions of the id and the text's hash, as many as the texts' bytes ask for
    (``partitions_for``), are sorted and cut into files of about ``tokens_per_shard`` ids (a
    longer document has a file alone).  Null text is empty (only the end id); null ids come first; rows
    with one id follow each other by the hash, so they lie in as many tasks as they need (equal rows in one);
    an empty table writes no file.  Other columns are ignored.  Returns the
    written manifest: shard (ascending in id order), path, documents, tokens.
    """
    vocabulary = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0
    parts = partitions_for(size, int(spark.conf.get("spark.sql.shuffle.partitions")), bytes_per_partition)
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    dealt = rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, model = TaskContext.get().partitionId(), encoder(vocabulary)
        end = np.array([end_id], model.dtype)
        doc_ids, lengths, held, size, k = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            uri = f"{path}/shard-{part:08d}-{k:06d}.wvm"
            write_file(uri, dump(doc_ids, lengths, np.concatenate(held)))
            return pa.RecordBatch.from_pydict({"shard": [part << 20 | k], "path": [uri],
                                               "documents": [len(doc_ids)], "tokens": [size]})

        for batch in batches:
            for first, ids, offsets in model.encode(batch.column(1)):
                for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    if size and size + b - a + 1 > tokens_per_shard:
                        yield flush()
                        doc_ids, lengths, held, size, k = [], [], [], 0, k + 1
                    doc_ids.append(batch.column(0)[first + i].as_py())
                    lengths.append(int(b - a) + 1)
                    held += [ids[a:b], end]
                    size += int(b - a) + 1
        if doc_ids:
            yield flush()

    found = dealt.mapInArrow(write, "shard long, path string, documents long, tokens long")
    return materialise(found, "wavelet-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document from its file: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32, shard, position (in the shard)."""
    placed = running_start(manifest, "shard", "tokens", "start", block=1 << 20)
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = placed.select("shard", "path", "start").repartition(parts, F.col("shard"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = WaveletShard(read_file(row["path"]))
                ids, ends = shard.decode(), np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.doc_ids, pa.int64()),
                    "start": pa.array(starts + row["start"], pa.int64()),
                    "n_tokens": pa.array(shard.lengths, pa.int64()),
                    "ids_crc32": pa.array([ids_crc32(ids[a:b]) for a, b in zip(starts, ends)], pa.int64()),
                    "shard": pa.array(np.full(len(starts), row["shard"]), pa.int64()),
                    "position": pa.array(starts, pa.int64())})

    return files.mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, position long")


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write the files of ``docs`` to a fresh shared folder and read them back."""
    path = shared_path(docs.sparkSession, "wavelet")
    return read_shards(write_shards(docs, path, **options))
