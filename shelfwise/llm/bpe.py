"""Byte-level BPE by merge replay over the vocabulary of a block of the corpus.

A task gathers a block of documents, splits them by the pattern and keeps each distinct piece once. An inverted index
from merge rank (a pair of tokens) to the positions where it stands in those pieces is replayed from the lowest rank
up: every merge is applied at once to all its positions, and only the pairs of the touched neighbours are looked up and
indexed anew. Documents are then put together from the ids of their pieces. A piece's merges depend on nothing outside
it, so the ids are those of one replay over the whole corpus, without a shuffle of every token that joining a corpus-wide
piece table back to the documents would take.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import over_blocks, whole

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NONE = np.int32(2**31 - 1)


class Merges:
    """Ranks of a rank file, as tables: token bytes, and for pairs of tokens the rank that they merge to."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pieces = {k: piece for piece, k in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.width = max(self.pieces) + 1
        self.sizes = np.array([len(self.pieces.get(k, b"")) for k in range(self.width)], np.int64)
        self.flat = np.frombuffer(b"".join(self.pieces.get(k, b"") for k in range(self.width)), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        pairs = {}
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                a, b = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens; ``NONE`` where they don't merge."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)

    def alone(self, piece: bytes) -> list[int]:
        """Ids of one piece: the lowest rank first, leftmost first."""
        tokens = [piece[k : k + 1] for k in range(len(piece))]
        while len(tokens) > 1:
            rank, at = min((self.ranks.get(tokens[k] + tokens[k + 1], NONE), k) for k in range(len(tokens) - 1))
            if rank == NONE:
                break
            tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]
        return [self.ranks[t] for t in tokens]


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def replayed(words: list[bytes], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and how many each has."""
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(words) else 0
    token = m.single[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    after[ends[lengths > 0] - 1] = -1
    before[(ends - lengths)[lengths > 0]] = -1
    alive = np.ones(n, bool)
    # The index: for each rank the positions whose token merges to it with the next one.
    first = np.flatnonzero(after >= 0).astype(np.int32)
    ranks = m.of(token[first], token[after[first]])
    first, ranks = first[ranks != NONE], ranks[ranks != NONE]
    order = np.argsort(ranks, kind="stable")
    cuts = np.flatnonzero(np.diff(ranks[order])) + 1
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    for group in np.split(order, cuts):
        if len(group):
            index[int(ranks[group[0]])].append(first[group])
    heap = list(index)
    heapq.heapify(heap)
    odd: set[int] = set()
    while heap:
        rank = heapq.heappop(heap)
        lists = index.pop(rank, None)
        if lists is None:
            continue
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[alive[at]]
        at = at[after[at] >= 0]
        at = at[m.of(token[at], token[after[at]]) == rank]  # others have changed since they were indexed
        if not len(at):
            continue
        follows = np.zeros(len(at), bool)
        follows[1:] = after[at[:-1]] == at[1:]
        if follows.any():  # a chain of overlapping pairs: every second one, from the left
            start = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
        gone = after[at]
        token[at] = rank
        alive[gone] = False
        beyond = after[gone]
        after[at] = beyond
        linked = beyond >= 0
        before[beyond[linked]] = at[linked]
        left = before[at]
        touched = np.unique(np.concatenate([left[left >= 0], at[linked]]))
        if not len(touched):
            continue
        new = m.of(token[touched], token[after[touched]])
        touched, new = touched[new != NONE], new[new != NONE]
        if not len(touched):
            continue
        if (new < rank).any():  # a lower rank appears: those words' other merges of this rank would have waited for it
            odd.update(word[touched[new < rank]].tolist())
        order = np.argsort(new, kind="stable")
        new, touched = new[order], touched[order]
        for group in np.split(np.arange(len(new)), np.flatnonzero(np.diff(new)) + 1):
            r = int(new[group[0]])
            if r not in index:
                heapq.heappush(heap, r)
            index[r].append(touched[group])
    ids, counts = token[alive], np.bincount(word[alive], minlength=len(words))
    if odd:
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k in odd:
            parts[k] = np.array(m.alone(words[k]), np.int32)
        ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
    whole_word = [(k, m.ranks[w]) for k, (w, count) in enumerate(zip(words, counts.tolist(), strict=True)) if count > 1 and w in m.ranks]
    if whole_word:  # a piece that is a token itself is that token, reached by merges or not
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k, rank in whole_word:
            parts[k] = np.array([rank], np.int32)
        ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
    return ids.astype("<u4"), counts


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` at ``starts`` of ``sizes`` that ``which`` names, one after another."""
    size = sizes[which]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[which] - ends + size, size) + np.arange(total)]


def encode_texts(texts: list[str], path: str, pattern: str = public_tokenizers.PATTERN) -> list[np.ndarray]:
    """Ids of each text."""
    find = regex.compile(pattern).findall
    numbers: dict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    pieces = []
    for text in texts:
        found = find(text)
        pieces.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
    ids, counts = replayed([w.encode() for w in numbers], merges(path))
    starts = np.cumsum(counts) - counts
    return [gathered(ids, starts, counts, at) for at in pieces]


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """Bytes of a sequence of ids."""
    m = merges(path)
    return gathered(m.flat, m.starts, m.sizes, ids).tobytes()


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every text; a null text is empty and has an empty array.

    Rows stay as they are: a repeated row is encoded again, an empty table gives no rows. Other columns are not read.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = encode_texts(block["text"].to_pylist(), path)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        values = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays([block["doc_id"].combine_chunks(), pa.ListArray.from_arrays(offsets, values)], names=["doc_id", "ids"])

    return over_blocks(whole(docs), run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of a table of ``doc_id`` and ``ids``; null ids are an empty text."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(np.array(x or [], np.uint32), path).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document the number of ids, the digest of the ids and the digest of the bytes decoded from them."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = encode_texts(block["text"].to_pylist(), path)
        yield pa.RecordBatch.from_arrays(
            [
                block["doc_id"].combine_chunks(),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(decode_ids(x, path)).hexdigest() for x in ids]),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return over_blocks(whole(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
