"""Packing of documents into training sequences by Karmarkar-Karp multiway differencing.

Each task packs the documents of its own partition, so nothing is shuffled. A document's full windows stand alone.
The rests are gathered until they fill a group of windows exactly (the last rest of a group is cut there), and each
group is partitioned into near-equal windows: the two partial partitions with the largest imbalance are merged,
largest window of one onto smallest of the other, until one is left. If a group's tokens exceed the capacity of its
windows, the window count rises. What a window still holds above its capacity is cut off and fills windows with room.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import whole
from .tokens import encoded

CAPACITY = 1024
#: Windows of a group that is partitioned together.
GROUP = 16
VOCABULARY = "byte_bpe_50k.json"
END = 0
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``windows`` near-equal parts (some may be empty)."""
    if not sizes:
        return [[] for _ in range(windows)]
    sums = [np.array([s] + [0] * (windows - 1)) for s in sizes]
    parts: list[list[list[int]]] = [[[k]] + [[] for _ in range(windows - 1)] for k in range(len(sizes))]
    heap = [(-s, k) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(-joined, kind="stable")
        parts[a] = [parts[a][j] + parts[b][windows - 1 - j] for j in order]
        sums[a], parts[b] = joined[order] - joined[order[-1]], []
        heapq.heappush(heap, (-int(sums[a][0]), a))
    return parts[heap[0][1]]


def partitioned(sizes: list[int], capacity: int, trim: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of (index, from, to) pieces of items of these sizes, none above ``capacity``.

    Without ``trim`` items stay whole (none may exceed the capacity) and the window count rises until all windows fit.
    """
    windows = max(1, -(-sum(sizes) // capacity))
    parts = differenced(sizes, windows)
    while not trim and max(sum(sizes[k] for k in part) for part in parts) > capacity:
        windows += 1
        parts = differenced(sizes, windows)
    out, above = [], []
    for part in parts:
        held, room = [], capacity
        for k in sorted(part, key=lambda k: (-sizes[k], k)):
            fits = min(sizes[k], room)
            if fits:
                held.append((k, 0, fits))
            if fits < sizes[k]:
                above.append((k, fits, sizes[k]))
            room -= fits
        out.append([held, room])
    for k, start, stop in above:
        for window in out:
            taken = min(window[1], stop - start)
            if taken:
                window[0].append((k, start, start + taken))
                window[1] -= taken
                start += taken
            if start == stop:
                break
    return [held for held, _ in out if held]


def pack(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence it lies where.

    A null text is empty and has only the end id. A repeated row is packed as often as it stands there. An empty table
    gives no rows. ``sequence_id`` is the task's number in the high bits and a count in the low 33. Only ``doc_id`` and
    ``text`` are read, so other columns may have any names.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 33
        rows: list[tuple] = []
        rests: list[tuple] = []  # document, ids, first id, all ids of the document
        waiting = 0

        def put(pieces) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset))
                offset += len(ids)
            sequence += 1

        def close() -> None:
            for window in partitioned([len(r[1]) for r in rests], capacity):
                put((rests[k][0], rests[k][2] + a, rests[k][1][a:b], rests[k][3]) for k, a, b in window)
            rests.clear()

        def table() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(NAMES)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoded(text.as_py(), path, end)
                total, at = len(ids), 0
                while total - at >= capacity:
                    put([(doc, at, ids[at : at + capacity], total)])
                    at += capacity
                while at < total:
                    taken = min(total - at, capacity * group - waiting)
                    rests.append((doc, ids[at : at + taken], at, total))
                    at, waiting = at + taken, waiting + taken
                    if waiting == capacity * group:
                        close()
                        waiting = 0
                if len(rows) >= 50_000:
                    yield table()
        if rests:
            close()
        yield table()

    return whole(docs).mapInArrow(run, SCHEMA)
