"""Language-model scores by Katz backoff.

A token is scored recursively: by its Good-Turing discounted bigram if training has seen it behind its history, else by
the history's backoff weight times the token's own discounted probability, else by the mass that discounting leaves for
unknown tokens. Backoff weights are exact: over the known tokens and the unknown one each history's probabilities sum
to 1. Each word is a history for itself. Weights of the ``FREQUENT`` most frequent ones are a table that is sent to every
task, of bounded size; those of all rarer ones are rows, joined by history to the documents that the history occurs in.

Counting and scoring are one exchange each. A task turns a block of documents into packets, one per partition of the
predicted word, with its distinct (word, history) pairs and the documents that hold them. A partition merges its packets
into a table of counts, so it knows all counts of its words, and keeps the documents beside them; these blobs are
written, one row per partition. The second exchange brings each block's sums back together; what weights of rare histories
add to a document is summed beside it and joined last.
"""

from __future__ import annotations

import io
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, over_blocks, partitions, remainder, small_batches, written

#: Rows with this remainder of crc32(doc_id) by 7 are not learned from.
HELD_OUT = (7, 2)
FREQUENT, CLASSES = 1 << 15, 1 << 16
START, RARE = CLASSES - 1, CLASSES - 2
#: Text bytes that a task works on as one block.
BLOCK = 12 << 20
#: Rows of a batch that a task gives back.
BATCH = 100_000
#: Counts up to this are discounted.
LARGE = 5
END = np.uint64(xxhash.xxh3_64_intdigest(b"", seed=1))
FIELDS = 2 * (LARGE + 1) + 2  # bigram and unigram counts of counts, tokens, distinct words


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def unpacked(blob: bytes | pa.Buffer) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(blob, max_output_size=2**31 - 1))) as found:
        return {k: found[k] for k in found.files}


def blobs(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    """What the first column's rows hold, one at a time and not copied before it is unpacked."""
    for blob in batch.column(0):
        yield unpacked(blob.as_buffer())


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words (the end first), all tokens as places in them with an end behind each
    text, tokens of each text."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = lambda: len(numbers) + 1
    parts, sizes, stop = [], [], np.zeros(1, np.int32)
    for text in texts:
        words = text.encode().lower().split()
        parts += [np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), stop]
        sizes.append(len(words) + 1)
    hashes = np.empty(len(numbers) + 1, np.uint64)
    hashes[0] = END
    hashes[1:] = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    return hashes, np.concatenate(parts), np.array(sizes, np.int64)


def reports(docs: DataFrame) -> DataFrame:
    """The words of a block's training documents, with their number there. All are reported, so which words come to be
    histories of their own depends on the corpus alone and not on how it is cut into blocks."""

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes, token, sizes = words_of(block["text"].to_pylist())
        learned = np.repeat(~block["held_out"].to_numpy(), sizes)
        counts = np.bincount(token[learned], minlength=len(hashes))
        counts[0] = 0
        held = counts > 0
        yield pa.RecordBatch.from_arrays([pa.array(hashes[held].view(np.int64)), pa.array(counts[held].astype(np.int64))], names=["word", "n"])

    return over_blocks(docs, run, "word long, n long", limit=BLOCK)


def history_classes(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The number of each word as a history, ``RARE`` if it is not among ``frequent``, which is sorted."""
    if not len(frequent):
        return np.full(len(hashes), RARE, np.int64)
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return np.where(frequent[at] == hashes, at, RARE)


PACKETS = "kind int, part int, block long, payload binary"


def packets(docs: DataFrame, frequent: np.ndarray, parts: int) -> DataFrame:
    """Kind 0: of one block, the pairs of one partition's words. Kind 1: the block's documents."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for block in blocks(batches, limit=BLOCK):
            yield from one(block, number)
            number += 1

    def one(block: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
        hashes, token, sizes = words_of(block["text"].to_pylist())
        held = block["held_out"].to_numpy()
        classes, width = history_classes(hashes, shared.value), CLASSES + len(hashes)
        own = np.where(classes == RARE, CLASSES + np.arange(len(hashes)), classes).astype(np.int32)  # a rare history by its place here
        history = np.empty(len(token), np.int32)
        history[1:] = own[token[:-1]]
        history[np.cumsum(sizes) - sizes] = START
        dealt = np.min_scalar_type(parts)
        part = ((hashes >> np.uint64(17)) % np.uint64(parts)).astype(dealt)
        order = np.argsort(part[token], kind="stable")  # tokens by partition; documents stay in order
        cuts = np.searchsorted(part[token][order], np.arange(parts + 1, dtype=dealt))
        place = np.empty(len(hashes), np.int64)
        place[np.argsort(hashes)] = np.arange(len(hashes))
        doc = np.repeat(np.arange(len(sizes), dtype=np.uint16 if len(sizes) <= 2**16 else np.uint32), sizes)
        flags = np.packbits(held)
        for p in range(parts):  # one at a time, so that wide arrays are those of one partition
            at = order[cuts[p] : cuts[p + 1]]
            if len(at):
                at = at[np.argsort(place[token[at]] * width + history[at], kind="stable")]
                w, h = token[at], history[at]
                pair = np.flatnonzero(np.append([True], (w[1:] != w[:-1]) | (h[1:] != h[:-1])))
                first, before = w[pair], h[pair]
                rare = before >= CLASSES
                starts = np.flatnonzero(np.append([True], first[1:] != first[:-1]))
                times = np.diff(np.append(pair, len(w)))
                yield packet(0, p, number, packed(word=hashes[first[starts]], kinds=np.diff(np.append(starts, len(first))).astype(np.uint32), history=np.where(rare, RARE, before).astype(np.uint16), rare=hashes[before[rare] - CLASSES], times=times.astype(np.uint32), doc=doc[at], held=flags))
        known = block["doc_id"].is_valid().to_numpy()
        yield packet(1, number % parts, number, packed(doc_id=block["doc_id"].fill_null(0).to_numpy(), known=known, tokens=sizes, held=held))

    def packet(kind: int, part: int, number: int, payload: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([payload], pa.binary())], names=["kind", "part", "block", "payload"])

    return docs.mapInArrow(run, PACKETS)


MERGED = "kind int, part int, block long, payload binary, stats array<long>"


def merged(found: DataFrame, parts: int) -> DataFrame:
    """Kind 0: a partition's words, pairs, counts of both, and the documents of each pair. Kind 1 as it is."""

    def row(kind: int, part: int, block: int, payload: bytes, stats: np.ndarray | None) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((kind, part, block, payload, stats), kinds, strict=True)], names=["kind", "part", "block", "payload", "stats"])

    def close(part: int, held: list[tuple[int, dict]]) -> pa.RecordBatch:
        word = np.concatenate([np.repeat(x["word"], x["kinds"]) for _, x in held])
        history = np.concatenate([x["history"] for _, x in held]).astype(np.int64)
        names, number = np.unique(np.concatenate([x["rare"] for _, x in held]), return_inverse=True)
        history[history == RARE] = CLASSES + number
        width = CLASSES + len(names)
        times = np.concatenate([x["times"] for _, x in held]).astype(np.int64)
        words, word = np.unique(word, return_inverse=True)
        pair, which = np.unique(word * width + history, return_inverse=True)
        which = np.repeat(which.astype(np.int32), times)
        doc = np.concatenate([x["doc"].astype(np.uint32) for _, x in held])
        block = np.repeat(np.arange(len(held), dtype=np.int32), [len(x["doc"]) for _, x in held])
        left_out = np.concatenate([np.unpackbits(x["held"])[x["doc"]] for _, x in held]).astype(bool)
        order = np.argsort(which, kind="stable")
        count = np.bincount(which[~left_out], minlength=len(pair))
        owner, before = pair // width, pair % width
        rare = before >= CLASSES
        uni = np.bincount(owner, count, len(words)).astype(np.int64)
        both = [np.bincount(np.minimum(x, LARGE + 2), minlength=LARGE + 3)[1 : LARGE + 2] for x in (count, uni)]
        stats = np.concatenate([*both, [uni.sum(), (uni > 0).sum()]]).astype(np.int64)
        shrunk = lambda x: x.astype(np.uint16 if not len(x) or x.max() < 2**16 else np.uint32)
        payload = packed(
            word=words, uni=uni, kinds=shrunk(np.bincount(owner, minlength=len(words))), history=np.where(rare, RARE, before).astype(np.uint16), rare=names[before[rare] - CLASSES], count=shrunk(count),
            times=shrunk(np.bincount(which, minlength=len(pair))), doc=shrunk(doc[order]), block=shrunk(block[order]), blocks=np.array([b for b, _ in held], np.int64),
        )
        return row(0, part, -1, payload, stats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, dict]] = []
        part = -1
        for batch in batches:
            for x in batch.to_pylist():
                if x["kind"]:
                    yield row(1, x["part"], x["block"], x["payload"], None)
                    continue
                if x["part"] != part and held:
                    yield close(part, held)
                    held = []
                part = x["part"]
                held.append((x["block"], unpacked(x["payload"])))
        if held:
            yield close(part, held)

    return found.repartition(parts, "part").sortWithinPartitions("kind", "part", "block").mapInArrow(run, MERGED)


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's ratios for counts 0 to ``LARGE``, then 1 for all larger, from the counts of counts 1 to ``LARGE + 1``.

    Where these do not fall as Good-Turing needs them to, a count keeps its value.
    """
    out = np.ones(LARGE + 2)
    n = n.astype(float)
    if n[0] and n[LARGE] and (LARGE + 1) * n[LARGE] < n[0]:
        cut = (LARGE + 1) * n[LARGE] / n[0]
        for r in range(1, LARGE + 1):
            ratio = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) if n[r - 1] else 1.0
            out[r] = ratio if 0 < ratio < 1 else 1.0
    return out


@dataclass
class Unigrams:
    """Discounted probabilities of single tokens; what is left goes to the unknown one."""

    tokens: int
    distinct: int
    ratios: np.ndarray
    scale: float
    unknown: float

    @classmethod
    def of(cls, n: np.ndarray, tokens: int, distinct: int) -> Unigrams:
        ratios = discounts(n)
        lost = sum((1 - ratios[r]) * r * n[r - 1] for r in range(1, LARGE + 1)) / max(tokens, 1)
        unknown = max(lost, 1 / (tokens + distinct + 1))
        return cls(tokens, distinct, ratios, (1 - unknown) / max(1 - lost, 1e-12), unknown)

    def __call__(self, count: np.ndarray) -> np.ndarray:
        p = self.scale * self.ratios[np.minimum(count, LARGE + 1)] * count / max(self.tokens, 1)
        return np.where(count > 0, p, self.unknown)


def weighed(model: DataFrame, ratios: np.ndarray, unigrams: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """Per frequent history, log10 of what a discounted count is multiplied by, and of the backoff weight; 0 for ``RARE``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, CLASSES))
        for batch in batches:
            for x in blobs(batch):
                history, count = x["history"], x["count"].astype(np.int64)
                single = np.repeat(unigrams(x["uni"]), x["kinds"])
                seen = count > 0
                for k, value in enumerate((count, ratios[np.minimum(count, LARGE + 1)] * count, np.where(seen, single, 0.0))):
                    sums[k] += np.bincount(history, value, CLASSES)
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(s[used]) for s in sums)], names=["h", "n", "kept", "single"])

    rows = model.select("payload").mapInArrow(run, "h long, n double, kept double, single double")
    table = rows.groupBy("h").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.sum("single").alias("single")).toArrow()
    h, n, kept, single = (table[k].to_numpy() for k in ("h", "n", "kept", "single"))
    left = np.maximum(1 - kept / n, 1 / (n + 2))  # never nothing, or an unseen token would have no probability
    factor, backoff = np.zeros(CLASSES), np.zeros(CLASSES)
    n, kept, single, left, h = (x[h != RARE] for x in (n, kept, single, left, h))
    factor[h] = np.log10((1 - left) / kept)
    backoff[h] = np.log10(left / np.maximum(1 - single, unigrams.unknown / 2))
    return factor, backoff


def of_rare(model: DataFrame, ratios: np.ndarray, unigrams: Unigrams) -> DataFrame:
    """What weights of rare histories add to the score of each document (``block``, ``doc``)."""

    def rows(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(columns["history"]), BATCH):
            yield pa.RecordBatch.from_pydict({name: pa.array(x[k : k + BATCH]) for name, x in columns.items()})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in blobs(batch):
                at = x["history"] == RARE
                count, (names, of) = x["count"][at].astype(np.int64), np.unique(x["rare"], return_inverse=True)
                single = np.where(count > 0, np.repeat(unigrams(x["uni"]), x["kinds"])[at], 0.0)
                n = np.bincount(of, count, len(names)).astype(np.int64)
                yield from rows({"history": names.view(np.int64), "n": n, "kept": np.bincount(of, ratios[np.minimum(count, LARGE + 1)] * count, len(names)), "single": np.bincount(of, single, len(names))})

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in blobs(batch):
                at, times = x["history"] == RARE, x["times"]
                ends, rare = np.append([0], np.cumsum(times, dtype=np.int64)), np.append([0], np.cumsum(at))
                for a in range(0, len(times), BATCH):  # so that wide arrays are those of some pairs
                    b = min(a + BATCH, len(times))
                    mine, n, held = at[a:b], times[a:b][at[a:b]], slice(ends[a], ends[b])
                    token = np.repeat(mine, times[a:b])
                    yield from rows({"history": np.repeat(x["rare"][rare[a] : rare[b]].view(np.int64), n), "block": x["blocks"][x["block"][held][token]], "doc": x["doc"][held][token].astype(np.int32), "seen": np.repeat(x["count"][a:b][mine] > 0, n)})

    payload = model.select("payload")
    sums = payload.mapInArrow(counted, "history long, n long, kept double, single double").groupBy("history").agg(*[F.sum(c).alias(c) for c in ("n", "kept", "single")]).where("n > 0")
    left = F.greatest(1 - F.col("kept") / F.col("n"), 1 / (F.col("n") + 2))
    weights = sums.select("history", F.log10((1 - left) / F.col("kept")).alias("factor"), F.log10(left / F.greatest(1 - F.col("single"), F.lit(unigrams.unknown / 2))).alias("backoff"))
    uses = payload.mapInArrow(used, "history long, block long, doc int, seen boolean")
    return uses.join(weights, "history").groupBy("block", "doc").agg(F.sum(F.when(F.col("seen"), F.col("factor")).otherwise(F.col("backoff"))).alias("of_rare"))


def scores(docs: DataFrame) -> DataFrame:
    """Every document's log10 probability under the Katz model (``score``) and under add-one unigrams (``base_score``).

    A null or empty text is its end alone; a text of any length is scored whole. A row with a null id is learned from and
    scored with a null id. Repeated rows are counted and scored as often as they stand there. Without training rows every token is unknown. An
    empty table gives no rows. Other columns than ``doc_id`` and ``text`` are not read. How the rows are dealt over
    partitions changes a score by no more than the rounding of its sum.
    """
    spark, parts = docs.sparkSession, partitions(docs.sparkSession)
    small_batches(spark)
    modulus, left_out = HELD_OUT
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), (remainder(doc_id, modulus) == left_out).alias("held_out"))
    top = reports(texts).groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").toArrow()
    frequent = np.sort(top["word"].to_numpy().view(np.uint64))
    tables = written(merged(packets(texts, frequent, parts), parts), "katz", compression="none")
    model = tables.where("kind = 0")
    totals = model.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    stats = np.zeros(FIELDS, np.int64)
    for r in totals:
        stats[r["pos"]] = r["n"]
    tokens, distinct = int(stats[-2]), int(stats[-1])
    ratios = discounts(stats[: LARGE + 1])
    unigrams = Unigrams.of(stats[LARGE + 1 : 2 * LARGE + 2], tokens, distinct)
    weights = spark.sparkContext.broadcast(weighed(model, ratios, unigrams))
    base_floor = math.log10(tokens + distinct + 1)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, backoff = weights.value
        for batch in batches:
            for x in blobs(batch):
                history, count, kinds = x["history"], x["count"].astype(np.int64), x["kinds"]
                single = np.repeat(np.log10(unigrams(x["uni"])), kinds)
                with np.errstate(divide="ignore"):
                    seen = np.log10(ratios[np.minimum(count, LARGE + 1)] * count) + factor[history]
                pair = np.where(count > 0, seen, single + backoff[history])
                known, base = np.repeat(x["uni"] > 0, kinds), np.repeat(np.log10(x["uni"] + 1), kinds)
                times = x["times"]
                which = np.repeat(np.arange(len(times), dtype=np.int32), times)
                order = np.argsort(x["block"], kind="stable")
                cuts = np.append([0], np.cumsum(np.bincount(x["block"], minlength=len(x["blocks"]))))
                for k, number in enumerate(x["blocks"].tolist()):
                    at = order[cuts[k] : cuts[k + 1]]
                    w = which[at]
                    doc, inverse = np.unique(x["doc"][at], return_inverse=True)
                    payload = packed(doc=doc.astype(np.uint32), score=np.bincount(inverse, pair[w]), base=np.bincount(inverse, base[w]), known=np.bincount(inverse, known[w]).astype(np.uint32))
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([0], pa.int32()), pa.array([payload])], names=["block", "kind", "payload"])

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "block", "doc"]

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, number = None, None
        for batch in batches:
            for x in batch.to_pylist():
                y = unpacked(x["payload"])
                if x["block"] != number:
                    if sums is not None:
                        yield told(number, *sums)
                    number, n = x["block"], len(y["tokens"])
                    sums = (y, np.zeros(n), np.zeros(n), np.zeros(n, np.int64))
                else:
                    sums[1][y["doc"]] += y["score"]
                    sums[2][y["doc"]] += y["base"]
                    sums[3][y["doc"]] += y["known"]
        if sums is not None:
            yield told(number, *sums)

    def told(number: int, y: dict, score: np.ndarray, base: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        n = len(score)
        columns = [pa.array(y["doc_id"], pa.int64(), mask=~y["known"]), pa.array(y["held"]), pa.array(y["tokens"]), pa.array(known), pa.array(np.full(n, tokens)), pa.array(base - y["tokens"] * base_floor), pa.array(score), pa.array(np.full(n, number, np.int64)), pa.array(np.arange(n, dtype=np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    sums = model.select("payload").mapInArrow(partial, "block long, kind int, payload binary").unionByName(tables.where("kind = 1").select("block", "kind", "payload"))
    ordered = sums.repartition(parts, "block").sortWithinPartitions("block", F.desc("kind"))
    found = ordered.mapInArrow(together, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, block long, doc int")
    found = found.join(of_rare(model, ratios, unigrams), ["block", "doc"], "left")
    return found.select(*names[:6], (F.col("score") + F.coalesce("of_rare", F.lit(0.0))).alias("score"))
