"""Exact Jaccard join of documents on word shingles, with skipping by set relations.

A document's set is its distinct word shingles, by 64-bit hash; equal sets are one set from the start. Under one global
order of shingles (rare before frequent) two sets that link share a shingle among the first few of each, so only those
prefixes are indexed: per shingle a list of (set size, position, set), dealt over tasks by shingle and, where the list
of a frequent shingle may be long, in pieces.

Answers are derived from those of similar sets instead of being compared pair by pair: sets that were found to link have
one component, and what one of them links with is an answer of all. In the first round a set is compared only with its
neighbour in each list, in the same order everywhere; then, in lists that still hold several components, with its
``NEAREST`` neighbours in ``ORDERS`` orders that differ from list to list (``chained``). Both make at most a few pairs for
each entry of the index. What is left is compared across components only (``across``): a list is a row of
blocks of one size each, in order of position, and a block's entries past the last position that could still reach the
needed overlap are skipped. Connected components come out exactly. A group of near copies costs its size; only a set
that shares rare shingles with a group and links with none of it is held against each of the group's sets.

Candidates are first held against parity bitmaps of about two bits per shingle: bits in which two bitmaps differ are at
least so many shingles in which the sets differ, so what that rules out cannot link. The rest is verified on whole sets,
for which only their documents' texts are read again.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import over_blocks, partitions, whole, written
from .components import components

WORDS, PERCENT = 4, 85
#: A shingle held by this many different sets of a block is reported as frequent; of the reports' sums, the highest are
#: kept: what is broadcast is bounded by it. Any order gives whole results, frequent shingles last only keeps lists short.
FREQUENT_IN_BLOCK, FREQUENT = 2, 1 << 19
CHUNK = 200_000
#: Sets of a list, or of two parts of one, that a task compares across components; sets of a chain. Longer ones are split.
PIECE, CHAIN = 20_000, 256
#: Orders of each list that are chained, and sets of a chain before a set that it is compared with. What they leave is
#: compared across components, so results do not depend on it.
ORDERS, NEAREST = 2, 4
#: Ids that are sent to every task to pick their documents; more are joined by a shuffle of the texts.
SENT = 500_000


def ceil(a, b):
    return -(-a // b)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle, one without words has none."""
    numbers: dict[bytes, int] = defaultdict(itertools.count().__next__)  # no reference cycle, which would outlive the call
    parts = []
    for text in texts:
        found = text.encode().lower().split()
        parts.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    sizes = np.array([len(p) for p in parts], np.int64)
    h = hashes[np.concatenate(parts)] if len(numbers) else np.empty(0, np.uint64)
    rolled = h[: max(len(h) - words + 1, 0)].copy()
    for k in range(1, words):
        rolled ^= rolled >> np.uint64(31)
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(rolled)]
    rolled = (rolled ^ rolled >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    out, at = [], 0
    for size in sizes.tolist():
        if size >= words:
            out.append(np.unique(rolled[at : at + size - words + 1]))
        elif size:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[at : at + size].tobytes(), seed=size)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += size
    return out


def signature(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), "<i8")
    return int(digest[0]), int(digest[1])


def parity(values: np.ndarray) -> bytes:
    """Bitmap whose bit k is the parity of the set's hashes that are k modulo its size, a power of two of at least 64 that
    follows from the set's size."""
    bits = max(64, 2 << (len(values) - 1).bit_length()) if len(values) else 64
    return np.packbits(np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, the larger folded to the size of the smaller."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(folded ^ b).sum())


def plausible(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """The pairs (``x``, ``y``) that their sets' bitmaps do not rule out."""
    x, y = (named.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}")) for k in "xy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_x").to_numpy() + batch.column("n_y").to_numpy()
            most = n - 2 * ceil(percent * n, 100 + percent)
            gap = np.array([differing(a, b) for a, b in zip(batch.column("bits_x").to_pylist(), batch.column("bits_y").to_pylist(), strict=True)], np.int64)
            yield batch.select(["x", "y"]).filter(pa.array(gap <= most))

    return pairs.join(x, "x").join(y, "y").mapInArrow(run, "x long, y long")


def hash_of(text: str) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def scanned(docs: DataFrame, words: int) -> DataFrame:
    """Kind 0: a document with the size, signature and bitmap of its set and its text's hash. Kind 1: a shingle (in ``a``) that is frequent in a
    block, with the number of different sets of the block that hold it (in ``n``)."""

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets(block["text"].to_pylist(), words)
        signed = np.array([signature(s) for s in sets], np.int64).reshape(-1, 2)
        once = np.unique(signed, axis=0, return_index=True)[1].tolist()
        shingles, counts = np.unique(np.concatenate([sets[k] for k in once]), return_counts=True)
        often = counts >= FREQUENT_IN_BLOCK
        n, m = len(sets), int(often.sum())
        ids = pa.concat_arrays([block["doc_id"].combine_chunks(), pa.nulls(m, pa.int64())])
        columns = [np.repeat([0, 1], [n, m]), np.concatenate([[len(s) for s in sets], counts[often]]), np.concatenate([signed[:, 0], shingles[often].view(np.int64)]), np.concatenate([signed[:, 1], np.zeros(m, np.int64)])]
        bits = pa.array([parity(s) for s in sets] + [None] * m, pa.binary())
        texts = pa.concat_arrays([block["text_hash"].combine_chunks(), pa.nulls(m, pa.int64())])
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c.astype(np.int64)) for c in columns), bits, texts], names=["doc_id", "kind", "n", "a", "b", "bits", "text_hash"])

    return over_blocks(whole(docs).withColumn("text_hash", hash_of("text")), run, "doc_id long, kind long, n long, a long, b long, bits binary, text_hash long")


def entries(docs: DataFrame, frequent: np.ndarray, holders: np.ndarray, words: int, percent: int) -> DataFrame:
    """The index: shingle, set size, position under the global order, signature, piece, for the prefix of every set.

    ``frequent``: the frequent shingles, rarest first; they come last in the order. ``holders``: documents known to hold
    each. A list that may hold more than ``PIECE`` sets has pieces from 1 on, any other is the piece 0.
    """
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order.astype(np.uint64), ceil(holders[order], PIECE)))

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        known, rank, pieces = shared.value
        done: set[tuple[int, int]] = set()
        parts = []
        for s in shingle_sets(block["text"].to_pylist(), words):
            if not len(s) or (sign := signature(s)) in done:
                continue
            done.add(sign)
            key, piece = s >> np.uint64(1), np.zeros(len(s), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                often = known[at] == s
                key = np.where(often, np.uint64(1 << 63) + rank[at], key)
                piece = np.where(often & (pieces[at] > 1), 1 + (sign[0] >> 7) % pieces[at], 0)
            first = np.argsort(key, kind="stable")[: len(s) - ceil(percent * len(s), 100) + 1]
            row = np.empty((len(first), 6), np.int64)
            row[:, 0] = s[first].view(np.int64)
            row[:, 1], row[:, 2] = len(s), np.arange(len(first))
            row[:, 3:5] = sign
            row[:, 5] = piece[first]
            parts.append(row)
        if parts:
            yield table(np.concatenate(parts), ["shingle", "n", "at", "a", "b", "piece"])

    return over_blocks(whole(docs), run, "shingle long, n long, at long, a long, b long, piece long")


def table(rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(rows.shape[1])], names=names)


def matrix(batches: list[pa.RecordBatch]) -> np.ndarray:
    """Rows of batches of longs."""
    return np.concatenate([np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1) for b in batches])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= CHUNK:
            yield matrix(held)
            held, size = [], 0
    if held:
        yield matrix(held)


def possible(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether entries of one list (columns 1 and 2: size, position), x no larger than y, may be of sets that link and
    that share no shingle before this one."""
    nx, ax, ny, ay = x[:, 1], x[:, 2], y[:, 1], y[:, 2]
    need = ceil(percent * (nx + ny), 100 + percent)
    return (100 * nx >= percent * ny) & (ax <= nx - ceil(2 * percent * nx, 100 + percent)) & (np.minimum(nx - ax, ny - ay) >= need)


def neighbours(index: DataFrame, percent: int) -> DataFrame:
    """Kind 0: pairs of neighbours in a piece of a list (``a``, ``b`` and ``c``, ``d``). Kind 1: the entries of lists that
    may hold three or more sets (``a``, ``b``: signature, ``c``: size, ``d``: position), with their shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.empty((0, 6), np.int64)  # the rows of the list that the last chunk ended in: two at most
        seen = 0  # rows of that list before those
        for rows in chunks(batches):
            rows = np.concatenate([last, rows])
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows[1:, [0, 3, 4]] != rows[:-1, [0, 3, 4]]).any(axis=1)  # equal sets of different blocks
            told = len(last)  # rows that the chunk before has told of
            keep = np.flatnonzero(fresh)
            rows, old = rows[keep], keep < told
            same = (rows[1:, [0, 5]] == rows[:-1, [0, 5]]).all(axis=1)
            new_pair = same & ~old[1:]
            x, y = rows[:-1][new_pair], rows[1:][new_pair]
            fits = possible(x, y, percent)
            x, y = x[fits], y[fits]
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            lengths = np.diff(np.append(starts, len(rows)))
            which = np.repeat(np.arange(len(starts)), lengths)
            total = lengths.copy()
            total[0] += seen
            long = (total >= 3)[which] | (rows[:, 5] > 0)
            told_before = old & ((seen > 0) | (old.sum() >= 3) | (rows[:, 5] > 0))
            tell = long & ~told_before
            z = rows[tell]
            out = np.concatenate([
                np.column_stack([np.zeros((len(x), 1), np.int64), x[:, [0, 3, 4]], y[:, [3, 4]]]),
                np.column_stack([np.ones((len(z), 1), np.int64), z[:, [0, 3, 4, 1, 2]]]),
            ])
            if len(out):
                yield table(out, ["kind", "shingle", "a", "b", "c", "d"])
            tail = rows[starts[-1] :]
            before = seen if len(starts) == 1 else 0
            last = tail[-2:]
            seen = before + len(tail) - len(last)

    ordered = index.repartition(partitions(index.sparkSession), "shingle", "piece").sortWithinPartitions("shingle", "piece", "n", "a", "b")
    return ordered.mapInArrow(run, "kind long, shingle long, a long, b long, c long, d long")


def reaches(x: Column, y: Column, percent: int) -> Column:
    """As ``possible``, of two structs of size (``n``) and position (``at``), in any order of size."""
    rest = F.least(x["n"] - x["at"], y["n"] - y["at"])
    return (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])) & (rest * (100 + percent) >= percent * (x["n"] + y["n"]))


def chained(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (``x``, ``y``) of neighbours of different components that may link. ``lists``: shingle, holders (entries of the
    list), n, at, id, component. Each list has orders of its own, among sets of about one size, in chains of about
    ``CHAIN`` sets. A list of at most ``NEAREST + 1`` sets has one order, which already holds each against every other."""
    orders = F.when(F.col("holders") <= NEAREST + 1, F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(ORDERS))))
    seeded = lists.withColumn("seed", F.explode(orders)).withColumn("mixed", F.xxhash64("shingle", "id", "seed"))
    order = Window.partitionBy("shingle", "seed", "chain").orderBy(F.floor(F.log("n") / math.log(100 / percent)), "mixed", "id")
    links = seeded.withColumn("chain", F.pmod("mixed", F.ceil(F.col("holders") / CHAIN)))
    entry = F.struct("n", "at", "id", "component")
    both = links.select(entry.alias("y"), F.array(*[F.lag(entry, k).over(order) for k in range(1, NEAREST + 1)]).alias("before"))
    y = F.col("y")
    near = F.filter("before", lambda x: x.isNotNull() & (x["component"] != y["component"]) & reaches(x, y, percent))
    pairs = both.select(y["id"].alias("b"), F.explode(F.transform(near, lambda x: x["id"])).alias("a"))
    return pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()


def across(lists: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Pairs (``x``, ``y``) of sets of different components in one list that may link. ``lists``: as of ``chained``, which
    has held the sets of its shortest lists against each other already.

    A list of more than ``PIECE`` sets is split into parts, and every two of them meet in a task.
    """

    def pairs(rows: np.ndarray, bits: list[bytes]) -> Iterator[np.ndarray]:
        """Of one list, sorted by size and position: per entry, of each block of sizes that can link the entries up to
        the last position that still reaches the needed overlap, if the bitmaps do not rule them out."""
        sizes, starts = np.unique(rows[:, 1], return_index=True)
        stops = np.append(starts[1:], len(rows))
        maps = [np.frombuffer(b"".join(bits[a:z]), np.uint8).reshape(z - a, -1) for a, z in zip(starts.tolist(), stops.tolist(), strict=True)]
        apart = bool(rows[0, 6] != rows[0, 7])  # two parts meet; pairs inside one are found elsewhere
        for big, (n, start, stop) in enumerate(zip(sizes.tolist(), starts.tolist(), stops.tolist(), strict=True)):
            for small in range(big, -1, -1):
                m = int(sizes[small])
                if 100 * m < percent * n:
                    break
                need = ceil(percent * (n + m), 100 + percent)
                reach = min(m - need, m - ceil(2 * percent * m, 100 + percent))
                block = rows[starts[small] : stops[small]]
                block = block[: np.searchsorted(block[:, 2], reach, "right")]  # skips the block's rest
                for k, y in enumerate(rows[start:stop]):
                    if n - y[2] < need or not len(block):
                        break  # and that of the larger sets
                    other = block[:, 4] != y[4]
                    if apart:
                        other &= block[:, 5] != y[5]
                    if other.any():
                        mine = np.bitwise_xor.reduce(maps[big][k].reshape(-1, maps[small].shape[1]), axis=0)
                        near = np.flatnonzero(other)
                        near = near[np.bitwise_count(maps[small][near] ^ mine).sum(axis=1) <= n + m - 2 * need]
                        if len(near):
                            yield np.column_stack([block[near, 3], np.full(len(near), y[3])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, left = np.empty((0, 8), np.int64), []

        def lists_of(rows: np.ndarray, bits: list[bytes]) -> Iterator[pa.RecordBatch]:
            cuts = [0, *(np.flatnonzero((rows[1:, [0, 6, 7]] != rows[:-1, [0, 6, 7]]).any(axis=1)) + 1).tolist(), len(rows)]
            held, size = [], 0
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                for found in pairs(rows[a:z], bits[a:z]):
                    held.append(found)
                    size += len(found)
                    if size >= CHUNK:
                        yield table(np.unique(np.concatenate(held), axis=0), ["x", "y"])
                        held, size = [], 0
            if held:
                yield table(np.unique(np.concatenate(held), axis=0), ["x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([rest, matrix([batch.select(batch.schema.names[:8])])])
            bits = left + batch.column("bits").to_pylist()
            last = (rows[:, [0, 6, 7]] == rows[-1, [0, 6, 7]]).all(axis=1)  # the last list may go on
            begin = int(np.argmax(last))
            if begin:
                yield from lists_of(rows[:begin], bits[:begin])
            rest, left = rows[begin:], bits[begin:]
        if len(rest):
            yield from lists_of(rest, left)

    lists, parts = lists.where(F.col("holders") > NEAREST + 1), F.ceil(F.col("holders") / PIECE).cast("long")
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("id"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    columns = ["shingle", "n", "at", "id", "component", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "bits"]
    dealt = dealt.join(named.select("id", "bits"), "id").select(columns)
    ordered = dealt.repartition(partitions(lists.sparkSession), "shingle", "low", "high").sortWithinPartitions("shingle", "low", "high", "n", "at", "id")
    found = ordered.mapInArrow(run, "x long, y long")
    return found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``x``, ``y``) whose whole sets (``id``, ``n``, ``shingles``) link."""
    x, y = (sets.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("shingles").alias(f"s_{k}")) for k in "xy")
    both = pairs.join(x, "x").join(y, "y").withColumn("shared", F.size(F.array_intersect("s_x", "s_y")))
    return both.where(100 * F.col("shared") >= percent * (F.col("n_x") + F.col("n_y") - F.col("shared"))).select("x", "y")


def linking(docs: DataFrame, pairs: DataFrame, named: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``x``, ``y``) of sets that link, as a written table."""
    pairs = written(pairs, "jaccard-pairs")
    members = pairs.select("x").union(pairs.select("y")).distinct().join(named, F.col("x") == F.col("id")).select("id", "doc_id", "a", "b")
    members = written(members, "jaccard-members")
    ids = members.select("doc_id").distinct()
    texts = whole(docs).join(F.broadcast(ids) if ids.count() <= SENT else ids, "doc_id", "left_semi")

    def of(block: pa.Table) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets(block["text"].to_pylist(), words)
        signed = np.array([signature(s) for s in sets], np.int64).reshape(-1, 2)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate(sets).view(np.int64)
        columns = [pa.array(np.ascontiguousarray(signed[:, k])) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(offsets, values)], names=["a", "b", "n", "shingles"])

    sets = over_blocks(texts, of, "a long, b long, n long, shingles array<long>")
    sets = written(sets.join(members.select("id", "a", "b"), ["a", "b"]).select("id", "n", "shingles").dropDuplicates(["id"]), "jaccard-sets")
    return written(verified(pairs, sets, percent).distinct(), "jaccard-links")


def placed(entries: DataFrame, linked: DataFrame) -> DataFrame:
    """The entries (shingle, n, at, id) of lists that hold several components, with ``component`` and ``holders``."""
    rows = entries.join(linked.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("holders")).where("low < high")
    return rows.join(mixed.select("shingle", "holders"), "shingle")


def joined(links: DataFrame) -> DataFrame:
    return written(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))), "jaccard-components")


def classed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``group`` (names a component, where rows that share an
    id may be of several) of every row."""
    scan = written(scanned(docs, words), "jaccard-scan")
    rows = scan.where("kind = 0").drop("kind")
    top = scan.where("kind = 1").groupBy("a").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "a").limit(FREQUENT).orderBy("n", "a").toArrow()
    index = entries(docs, top["a"].to_numpy().view(np.uint64), top["n"].to_numpy(), words, percent)
    first = written(neighbours(index, percent), "jaccard-lists")
    named = rows.where("n > 0 and doc_id is not null").groupBy("a", "b").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.min("bits").alias("bits"))
    named = written(named.withColumn("id", F.monotonically_increasing_id()), "jaccard-named")  # two sets may have one doc_id
    label = lambda a, b, k: named.select(F.col("a").alias(a), F.col("b").alias(b), F.col("id").alias(k))
    near = first.where("kind = 0").select("a", "b", "c", "d").distinct().join(label("a", "b", "x"), ["a", "b"]).join(label("c", "d", "y"), ["c", "d"])
    near = near.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    links = linking(docs, plausible(near, named, percent), named, words, percent)
    linked = joined(links)
    lists = first.where("kind = 1").select("shingle", "a", "b", F.col("c").alias("n"), F.col("d").alias("at")).join(label("a", "b", "id"), ["a", "b"]).drop("a", "b")
    lists = written(placed(lists, linked), "jaccard-placed")
    links = links.union(linking(docs, plausible(chained(lists, percent), named, percent), named, words, percent))
    linked = joined(links)
    lists = placed(lists.drop("component", "holders"), linked)
    found = linking(docs, across(lists, named, percent), named, words, percent)
    if not found.isEmpty():
        linked = joined(links.union(found))
    lowest = named.join(linked, F.col("id") == F.col("node")).groupBy("component").agg(F.min("doc_id").alias("lowest"))
    found = named.join(linked.join(lowest, "component"), F.col("id") == F.col("node"), "left")
    told = rows.join(found.select("a", "b", F.coalesce("lowest", "doc_id").alias("lowest"), F.coalesce("component", "id").alias("group")), ["a", "b"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return told.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"), "group")


def classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    A null or empty text has an empty set and links with nothing, as does a row with a null id (its component is null).
    Repeated rows are copies of each other; rows that share an id but not the text are rows of their own, each with the
    smallest id that it reaches. A text is one set however long it is; a text of fewer words than a shingle is one
    shingle. Ties of similarity at the threshold link. An empty table gives no rows. Other columns are not read.
    """
    return classed(docs, words, percent).drop("text_hash", "group")


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that with the smallest id, with its own columns.

    Of rows that share this id but not the text, the one with the lowest hash of the text stays, and of rows that repeat
    id and text one. Rows with a null id stay, and so does one row of each id without words. Only ids and text hashes are
    joined; no text is shuffled but those of rows that are repeated.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    taken = {c.lower() for c in docs.columns}
    key, rank = (next(n for k in range(len(taken) + 1) if (n := f"__{name}{k}") not in taken) for name in ("id", "hash"))
    rows = written(classed(docs, words, percent).where("doc_id is not null").groupBy("doc_id", "text_hash").agg(F.min("group").alias("group"), F.max("n_shingles").alias("n"), F.count("*").alias("copies")), "jaccard-rows")
    first = rows.where("n > 0").groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    gone = rows.where("n > 0").join(first, "group").where("struct(doc_id, text_hash) != kept").select("doc_id", "text_hash")
    twice = rows.where("copies > 1").join(gone, ["doc_id", "text_hash"], "left_anti")
    marked = docs.withColumns({key: F.col("doc_id").cast("long"), rank: hash_of("text")})
    name = lambda table: table.select(F.col("doc_id").alias(key), F.col("text_hash").alias(rank))
    kept = marked.join(name(gone.unionByName(twice.select("doc_id", "text_hash"))), [key, rank], "left_anti")
    again = marked.join(name(twice), [key, rank], "left_semi").dropDuplicates([key, rank])
    return kept.unionByName(again).select(names)
