"""Token ids in shards, each a wavelet matrix in one compressed blob.

A shard holds the ids of consecutive documents (ascending ``doc_id``). Its wavelet matrix keeps one bit-plane per bit
of an id, highest first; behind each plane the ids are stably parted by that bit. With a directory of ranks every 512
bits, ``access``, ``rank`` (occurrences of a token before a position) and ``select`` (place of its k-th occurrence)
read a few words of each plane and never the other documents. The blob of a shard is a row of a Parquet table, so any
store that Spark reads can hold it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, whole, written
from .tokens import encoded

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Ids that a shard holds at least (one document's ids are never parted), unless it is the last of its partition.
SHARD_IDS = 1 << 21
MAGIC = b"WMX1"
BLOCK = 512  # bits between two entries of a rank directory


class WaveletMatrix:
    """Wavelet matrix over ids below ``2 ** bits``."""

    def __init__(self, n: int, bits: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.bits, self.planes, self.zeros, self.ranks = n, bits, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        bits = max(bits or 1, top.bit_length(), 1)
        values = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for level in range(bits - 1, -1, -1):
            ones = (values >> level) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            planes.append(packed)
            ranks.append(cls.directory(packed))
            parted = values[~ones]
            zeros.append(len(parted))
            values = np.concatenate([parted, values[ones]])
        return cls(len(ids), bits, planes, zeros, ranks)

    @staticmethod
    def directory(packed: np.ndarray) -> np.ndarray:
        """Ones before each block of ``BLOCK`` bits."""
        size = BLOCK // 8
        padded = np.zeros(-(-len(packed) // size) * size, np.uint8)
        padded[: len(packed)] = packed
        ones = np.bitwise_count(padded.reshape(-1, size)).sum(axis=1, dtype=np.uint32) if len(padded) else np.empty(0, np.uint32)
        return np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    def ones(self, level: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        block, plane = at // BLOCK, self.planes[level]
        first, last = block * (BLOCK // 8), at // 8
        count = int(self.ranks[level][block]) + int(np.bitwise_count(plane[first:last]).sum())
        return count + (int(plane[last]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else count

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.bits):
            bit = int(self.planes[level][at // 8]) >> at % 8 & 1
            one = self.ones(level, at)
            at = self.zeros[level] + one if bit else at - one
            value = value << 1 | bit
        return value

    def interval(self, token: int, stop: int) -> tuple[int, int]:
        """Where the token's occurrences before ``stop`` lie behind the last plane."""
        start = 0
        for level in range(self.bits):
            bit = token >> (self.bits - 1 - level) & 1
            a, b = self.ones(level, start), self.ones(level, stop)
            start, stop = (self.zeros[level] + a, self.zeros[level] + b) if bit else (start - a, stop - b)
        return start, stop

    def rank(self, token: int, stop: int | None = None) -> int:
        """Occurrences of a token before position ``stop``."""
        if token >> self.bits:
            return 0
        start, end = self.interval(token, self.n if stop is None else max(0, min(stop, self.n)))
        return end - start

    def chosen(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of this kind in a plane."""
        low, high = 0, self.n
        while low < high:  # the last position with at most k such bits before it
            mid = (low + high + 1) // 2
            before = self.ones(level, mid)
            if (before if bit else mid - before) <= k:
                low = mid
            else:
                high = mid - 1
        return low

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token; -1 if there are fewer."""
        if token >> self.bits or not 0 <= k < self.rank(token):
            return -1
        at = self.interval(token, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self.chosen(level, bit, at - self.zeros[level] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids, by undoing the parting plane by plane."""
        values = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            whole = np.empty_like(values)
            whole[~ones] = values[: self.zeros[level]]
            whole[ones] = values[self.zeros[level] :] | values.dtype.type(1 << (self.bits - 1 - level))
            values = whole
        return values.astype("<u4")

    def blob(self) -> bytes:
        """Header, zero counts and planes, each plane compressed on its own; rank directories are rebuilt on loading."""
        pack = zstandard.ZstdCompressor(level=1).compress
        planes = [pack(p.tobytes()) for p in self.planes]
        head = MAGIC + struct.pack("<QI", self.n, self.bits)
        return head + b"".join(struct.pack("<QQ", z, len(p)) for z, p in zip(self.zeros, planes, strict=True)) + b"".join(planes)

    @classmethod
    def load(cls, blob: bytes) -> WaveletMatrix:
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QI", blob, 4)
        sizes = [struct.unpack_from("<QQ", blob, 16 + 16 * k) for k in range(bits)]
        at, planes = 16 + 16 * bits, []
        for _, size in sizes:
            plane = zstandard.ZstdDecompressor().decompress(blob[at : at + size], max_output_size=-(-n // 8) + 1) if size else b""
            planes.append(np.frombuffer(plane, np.uint8))
            at += size
        return cls(n, bits, planes, [z for z, _ in sizes], [cls.directory(p) for p in planes])


SHARDS = "part int, shard int, before long, null_ids int, doc_ids binary, lengths binary, n_ids long, matrix binary"


def shards(docs: DataFrame, vocabulary: str | None = None, end: int = END, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shards of the ids of all documents in ascending ``doc_id``, each document closed by the end id.

    A null text is empty and has only the end id; null ids sort first, and a shard tells how many of its first
    documents have none. Repeated rows are written as often as they stand there, next to each other. A text of any length
    lies in one shard. ``before`` counts the ids of the writing task's earlier shards. An empty table gives no shards.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, shard = (context.partitionId() if context else 0), 0
        names: list[int] = []
        held: list[np.ndarray] = []
        size = before = nulls = 0

        def close() -> pa.RecordBatch:
            row = {
                "part": [part], "shard": [shard], "before": [before], "null_ids": [nulls], "doc_ids": [np.array(names, "<i8").tobytes()],
                "lengths": [np.array([len(x) for x in held], "<i8").tobytes()], "n_ids": [size],
                "matrix": [WaveletMatrix.build(np.concatenate(held)).blob()],
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names.append(0 if doc is None else doc)
                nulls += doc is None
                held.append(encoded(text.as_py(), path, end).astype(np.uint16 if end < 2**16 and path == public_tokenizers.path(VOCABULARY) else np.uint32))
                size += len(held[-1])
                if size >= shard_ids:
                    yield close()
                    shard, before, size, nulls = shard + 1, before + size, 0, 0
                    names.clear()
                    held.clear()
        if names:
            yield close()

    ordered = whole(docs).repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(run, SHARDS)


def write(docs: DataFrame, **options) -> DataFrame:
    """``shards`` written as a table in the shared folder and read back. Blobs are compressed already."""
    return written(shards(docs, **options), "wavelet", compression="none")


def read(table: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the shards alone.

    What is gathered on the driver is one sum per partition of the writer, whose number is the session's setting.
    """
    sums = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    bases, total = {}, 0
    for part in sorted(sums):
        bases[part] = total
        total += sums[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, lengths = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
                ids = WaveletMatrix.load(row["matrix"]).ids()
                stops = np.cumsum(lengths)
                starts = stops - lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                unnamed = np.arange(len(names)) < row["null_ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, mask=unnamed), pa.array(starts + (row["before"] + bases[row["part"]])), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    columns = ["part", "before", "null_ids", "doc_ids", "lengths", "matrix"]
    return table.select(columns).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(table: DataFrame, token: int) -> DataFrame:
    """Per shard how often a token occurs and the first place, without decoding the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [WaveletMatrix.load(m) for m in batch.column("matrix").to_pylist()]
            columns = [batch.column("part"), batch.column("shard"), pa.array([m.rank(token) for m in found], pa.int64()), pa.array([m.select(token, 0) for m in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "shard", "occurrences", "first"])

    return table.select("part", "shard", "matrix").mapInArrow(run, "part int, shard int, occurrences long, first long")
