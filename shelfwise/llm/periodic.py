"""Periodic runs of words: the linear tandem-repeat method on a suffix tree.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least
``least_words`` words and ``least_power`` periods.

* A word of such a run lies in a window of ``window`` words that occurs again in the same text, q words away. So the words
  outside of such windows are in no run, and each stretch of words inside is searched alone (``stretches``).
* Stretches of many texts are strung together, each behind an end mark of its own, and searched at once (``found``):
  names of all factors of power-of-two length give the order of suffixes and common extensions to both sides; Lempel-Ziv
  blocks give squares that cover, for each square, its leftmost occurrence; walks along the suffix links of the suffix tree
  complete the vocabulary of squares; their occurrences, located by the leaves below, merge into runs. Only squares whose
  root is no power of a shorter one are kept, as only they tell of a smallest period.

The method works inside a text, so nothing is shuffled. Memory of a task: ``TEXT_BYTES`` of texts as words and some 300 bytes
for each word of ``STRUNG`` words of stretches, or of one longer stretch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import over_blocks, whole

#: Words of stretches that are searched at once, unless one stretch is longer.
STRUNG = 1 << 17
#: Text bytes whose words are held at once, unless one text is longer.
TEXT_BYTES = 4 << 20
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
Run = tuple[int, int, int]
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def window(least_words: int, least_power: int) -> int:
    """Words of a window that is sure to occur twice in every run: the greatest power of two that is not above what the
    shortest run of any period has beyond its first period."""
    edge = least_words // least_power
    beyond = min(least_words - edge, (least_power - 1) * (edge + 1))
    return 1 << (max(1, beyond).bit_length() - 1)


def stretches(words: list[bytes], width: int) -> Iterator[tuple[int, int]]:
    """First and end positions of the stretches of words in windows that occur more than once, by hashes of windows: equal
    windows have equal hashes, so no run is missed."""
    n = len(words)
    if n <= width:
        return
    h = np.fromiter(map(hash, words), dtype=np.int64, count=n).view(np.uint64)
    size = 1
    while size < width:
        h = h[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return
    at = np.flatnonzero(np.isin(h, twice))
    cuts = np.flatnonzero(np.diff(at) > width)
    for first, last in zip(at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]], strict=True):
        yield int(first), int(last) + width


class Factors:
    """Names of the factors of power-of-two length of ``s``, which ends in a symbol of its own: factors of a length have
    equal names where they are equal, in their order."""

    def __init__(self, s: np.ndarray):
        self.s, self.n = s, len(s)
        self.levels = [np.unique(s, return_inverse=True)[1].astype(np.int32)]
        while (size := 1 << (len(self.levels) - 1)) < self.n and int(self.levels[-1].max()) < self.n - 1:
            now = self.levels[-1].astype(np.int64)
            behind = np.zeros(self.n, dtype=np.int64)
            behind[: self.n - size] = now[size:] + 1
            self.levels.append(np.unique(now * (self.n + 1) + behind, return_inverse=True)[1].astype(np.int32))
        self.rank = self.levels[-1]
        self.order = np.empty(self.n, dtype=np.int32)
        self.order[self.rank] = np.arange(self.n, dtype=np.int32)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common factor that starts at ``i`` and at ``j``, which differ."""
        i, j = i.astype(np.int64), j.astype(np.int64)
        begun = i.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[level], 1 << level
            inside = (i < self.n) & (j < self.n)
            same = inside & (names[np.where(inside, i, 0)] == names[np.where(inside, j, 0)])
            i += size * same
            j += size * same
        return i - begun

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common factor that ends before ``i`` and before ``j``."""
        i, j = i.astype(np.int64), j.astype(np.int64)
        begun = i.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[level], 1 << level
            inside = (i >= size) & (j >= size)
            same = inside & (names[np.where(inside, i - size, 0)] == names[np.where(inside, j - size, 0)])
            i -= size * same
            j -= size * same
        return begun - i

    def key(self, i: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A number that tells factors of the same length apart; lengths above 0."""
        level = np.minimum(np.floor(np.log2(length)).astype(np.int64), len(self.levels) - 1)
        table = np.stack(self.levels)
        reach = np.where(level == len(self.levels) - 1, i, i + length - (1 << level))  # names of the last level are unique
        return table[level, i].astype(np.int64) * (self.n + 1) + table[level, reach]


class SuffixTree:
    """Nodes of the suffix tree of ``factors.s``: leaves 0 to n-1 by rank of their suffix, then inner nodes, the last the
    root. ``depth``, ``parent``, ``low`` and ``high`` (ranks below), ``link`` of inner nodes, and ``child`` by node and
    symbol."""

    def __init__(self, factors: Factors):
        self.s, self.order, n = factors.s.tolist(), factors.order.tolist(), factors.n
        common = np.zeros(n, dtype=np.int64)
        common[1:] = factors.forward(factors.order[:-1], factors.order[1:])
        depth, parent, low, high = [n - p for p in self.order], [0] * n, list(range(n)), list(range(n))
        open_nodes: list[tuple[int, int, list[int]]] = [(0, 0, [])]  # depth, first rank, children
        for rank, shared in enumerate([*common.tolist()[1:], -1]):
            child, first = rank, rank
            while open_nodes and open_nodes[-1][0] > shared:
                d, first, below = open_nodes.pop()
                below.append(child)
                node = len(depth)
                depth.append(d)
                parent.append(node)
                low.append(first)
                high.append(rank)
                for b in below:
                    parent[b] = node
                child = node
            if shared < 0:
                break
            if open_nodes[-1][0] == shared:
                open_nodes[-1][2].append(child)
            else:
                open_nodes.append((shared, first, [child]))
        self.depth, self.parent, self.low, self.high, self.root, self.n = depth, parent, low, high, len(depth) - 1, n
        self.link = self._links(factors)
        s, order = self.s, self.order
        self.child = {(p, s[order[low[v]] + depth[p]]): v for v, p in enumerate(parent) if v != p}

    def _links(self, factors: Factors) -> list[int]:
        n, inner = self.n, np.arange(self.n, self.root)
        at, depth = factors.order[np.array(self.low)[inner]].astype(np.int64), np.array(self.depth)[inner]
        deep = depth > 1
        keys = np.concatenate([factors.key(at, depth), factors.key(at[deep] + 1, depth[deep] - 1)])
        named = np.unique(keys, return_inverse=True)[1] * (n + 1) + np.concatenate([depth, depth[deep] - 1])
        own, wanted = named[: len(inner)], named[len(inner) :]
        ordered = np.argsort(own)
        link = np.full(self.root + 1, self.root)
        link[inner[deep]] = inner[ordered[np.searchsorted(own[ordered], wanted)]]
        return link.tolist()

    def below(self, node: int, start: int, length: int) -> int:
        """The first node at or below the place of ``s[start:start + length]``, from a node on its path."""
        depth, child, s = self.depth, self.child, self.s
        while depth[node] < length:
            node = child[node, s[start + depth[node]]]
        return node


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each count, the numbers 1 to the count, and whose they are."""
    whose = np.repeat(np.arange(len(counts)), counts)
    return whose, np.arange(len(whose)) - np.repeat(np.cumsum(counts) - counts, counts) + 1


def block_starts(factors: Factors) -> np.ndarray:
    """Where the Lempel-Ziv blocks begin: each is the longest factor with an earlier occurrence, or one new symbol."""
    n, order = factors.n, factors.order.tolist()
    before, after, stack = [-1] * n, [-1] * n, []
    for p in order:  # the nearest suffixes in order, on both sides, that start further left
        while stack and stack[-1] > p:
            after[stack.pop()] = p
        before[p] = stack[-1] if stack else -1
        stack.append(p)
    here, longest = np.arange(n), np.zeros(n, dtype=np.int64)
    for other in (np.array(before), np.array(after)):
        known = np.flatnonzero(other >= 0)
        longest[known] = np.maximum(longest[known], factors.forward(other[known], here[known]))
    starts, lengths, p = [], longest.tolist(), 0
    while p < n:
        starts.append(p)
        p += max(1, lengths[p])
    return np.array(starts)


def covering_squares(factors: Factors, longest_period: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of squares such that the leftmost occurrence of every square is one of them or follows one word by
    word: those that cross the end of a block from inside, and those that begin left of a block."""
    n, begin = factors.n, block_starts(factors)
    end = np.r_[begin[1:], n]
    own = end - begin
    after = np.r_[own[1:], 0]
    found = []
    whose, k = _ranges(np.minimum(own, longest_period))
    edge = end[whose]
    keep = edge < n
    found.append((edge[keep], edge[keep] - k[keep], k[keep], True))
    whose, k = _ranges(np.minimum(own + after, longest_period))
    edge = begin[whose]
    keep = (edge > 0) & (edge + k < n)
    found.append((edge[keep], edge[keep] + k[keep], k[keep], False))
    starts, periods = [], []
    for edge, other, k, inside in found:
        right, left = factors.forward(edge, other), factors.backward(edge, other)
        at = np.minimum(edge, other)
        start = np.maximum(at - left, at - k + 1)
        square = (right + left >= k) & (right > 0) & (True if inside else left > 0)
        starts.append(start[square])
        periods.append(k[square])
    return np.concatenate(starts), np.concatenate(periods)


def primitive(factors: Factors, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the roots of squares are no powers of shorter words, tried by each prime part of the period."""
    least = np.arange(int(period.max(initial=1)) + 1)
    for p in range(2, int(len(least) ** 0.5) + 1):
        if least[p] == p:
            multiples = least[p * p :: p]
            multiples[multiples == np.arange(p * p, len(least), p)] = p
    is_primitive, rest = np.ones(len(start), dtype=bool), period.copy()
    while (rest > 1).any():
        at = np.flatnonzero(rest > 1)
        prime = least[rest[at]]
        shorter = period[at] // prime
        is_primitive[at] &= factors.forward(start[at], start[at] + shorter) < 2 * period[at] - shorter
        while True:
            divides = rest[at] % prime == 0
            if not divides.any():
                break
            rest[at] = np.where(divides, rest[at] // prime, rest[at])
    return is_primitive


def vocabulary(tree: SuffixTree, starts: list[int], periods: list[int]) -> tuple[list[int], list[int]]:
    """Nodes and periods of all squares: the given ones, and from each the walk along suffix links, by which a square's
    first symbol moves to its end as long as the tree has the outcome and it's new."""
    s, order, depth, parent, link, low, child = tree.s, tree.order, tree.depth, tree.parent, tree.link, tree.low, tree.child
    rank = [0] * tree.n
    for r, p in enumerate(order):
        rank[p] = r
    seen: set[tuple[int, int]] = set()
    nodes, found = [], []
    for start, k in zip(starts, periods, strict=True):
        length = 2 * k
        node = rank[start]
        while depth[parent[node]] >= length:
            node = parent[node]
        while (node, k) not in seen:
            seen.add((node, k))
            nodes.append(node)
            found.append(k)
            at = order[low[node]]
            first, up = s[at], parent[node]
            node = tree.below(link[up], at + 1, length - 1)
            if depth[node] == length - 1:
                node = child.get((node, first), -1)
                if node < 0:
                    break
            elif s[order[low[node]] + length - 1] != first:
                break
    return nodes, found


def merged(tree: SuffixTree, factors: Factors, nodes: list[int], periods: list[int]) -> np.ndarray:
    """Runs as rows of start, length and period: the squares' occurrences, those that follow each other word by word in one."""
    low = np.array([tree.low[v] for v in nodes], dtype=np.int64)
    whose, k = _ranges(np.array([tree.high[v] for v in nodes], dtype=np.int64) - low + 1)
    at, period = factors.order[low[whose] + k - 1].astype(np.int64), np.array(periods, dtype=np.int64)[whose]
    by = np.lexsort((at, period))
    at, period = at[by], period[by]
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], len(at)] - 1
    return np.stack([at[first], at[last] + 2 * period[first] - at[first], period[first]], axis=1)


def found(parts: list[list[bytes]], least_words: int, least_power: int) -> list[list[Run]]:
    """The runs (start, length, period) of each part, by start, then period."""
    codes: dict[bytes, int] = {}
    symbols: list[int] = []
    offsets = []
    for k, part in enumerate(parts):
        offsets.append(len(symbols))
        symbols.extend(codes.setdefault(w, len(codes)) for w in part)
        symbols.append(-1 - k)  # an end mark of its own
    out: list[list[Run]] = [[] for _ in parts]
    factors = Factors(np.array(symbols, dtype=np.int64))
    starts, periods = covering_squares(factors, max(map(len, parts)) // least_power)
    if len(starts):
        keep = primitive(factors, starts, periods)
        starts, periods = starts[keep], periods[keep]
    if not len(starts):
        return out
    tree = SuffixTree(factors)
    rows = merged(tree, factors, *vocabulary(tree, starts.tolist(), periods.tolist()))
    rows = rows[rows[:, 1] >= np.maximum(least_words, least_power * rows[:, 2])]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    part = np.searchsorted(offsets, rows[:, 0], side="right") - 1
    for p, (start, length, period) in zip(part.tolist(), rows.tolist(), strict=True):
        out[p].append((start - offsets[p], length, period))
    return out


def searched(texts: list[list[bytes]], least_words: int, least_power: int) -> list[list[Run]]:
    """The runs of each text's words, by start, then period."""
    width = window(least_words, least_power)
    out: list[list[Run]] = [[] for _ in texts]
    spans = iter([(k, a, b) for k, words in enumerate(texts) for a, b in stretches(words, width) if b - a >= least_words])
    held: list[tuple[int, int, int]] = []
    size = 0
    for span in spans:
        if held and size + span[2] - span[1] > STRUNG:
            _searched(texts, held, out, least_words, least_power)
            held, size = [], 0
        held.append(span)
        size += span[2] - span[1]
    if held:
        _searched(texts, held, out, least_words, least_power)
    return out


def _searched(texts: list[list[bytes]], spans: list[tuple[int, int, int]], out: list[list[Run]], least_words: int, least_power: int) -> None:
    parts = [list(islice(texts[k], a, b)) for k, a, b in spans]
    for (k, a, _), runs in zip(spans, found(parts, least_words, least_power), strict=True):
        out[k] += [(a + start, length, period) for start, length, period in runs]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exponent, compared exactly; then of the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words: in a tenth of the texts, by crc32 of the id, the words from some place on are made periodic.
    A text without id stays as it is."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * -(-(n - a) // p))[: n - a]


def periodic(docs: DataFrame, least_words: int = 24, least_power: int = 3, prepare: Prepare | None = None) -> DataFrame:
    """Per text the runs of its words (stretches without space and tab to carriage return): how many, the one of the
    greatest exponent, a digest of all, and one of the text with each run collapsed to its first period.

    A null or empty text has no words and no runs; the run's columns are then null and the digests those of nothing.
    Repeated rows and ids are kept apart, null ids stay null; other columns are left behind. ``prepare`` may change a
    text's words first."""
    if least_power < 2 or least_words < 2:
        raise ValueError("a run has two periods and two words at least")

    names = [column.split()[0] for column in SCHEMA.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def work(block: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = block.column("doc_id").to_pylist()
        texts = [t.split() for t in block.column("text").cast(pa.binary()).to_pylist()]
        if prepare:
            texts = [prepare(i, words) for i, words in zip(ids, texts, strict=True)]
        rows = []
        for i, words, runs in zip(ids, texts, searched(texts, least_words, least_power), strict=True):
            best = strongest(runs)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
            rows.append((i, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return over_blocks(whole(docs), work, SCHEMA, limit=TEXT_BYTES)
