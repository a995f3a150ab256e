"""Toxicity from class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary documents, are counted on a bounded sample of labelled rows. Each class
interpolates its word bigrams with its own continuation counts of words, and those with counts that both classes share:
in how many classes a word was seen, and how words are spelled by letter n-grams. So an expression that one class has
hardly seen is judged by the counts that it shares with the other, not by its absence. A text's evidence is the
difference of its log-likelihoods under the two models, normalised by length: over the whole text, and over its
``STRONGEST`` strongest words, as insults in a long text are diluted over the whole. A logistic curve fitted on labelled
rows that were not counted turns them into a probability.

Counts are tables, grouped by Spark. What the driver receives and sends to the tasks are their sorted keys and sums; the
sample bounds them, in rows and in characters.
"""

from __future__ import annotations

import ctypes
import gc
import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_blocks, remainder, small_batches, whole, written

#: Rows of each class that the models are counted on, and that the curve is fitted on, and characters of these rows: the
#: bound of the sample. Rows that would exceed the characters are passed over, never cut.
COUNT_ROWS, CURVE_ROWS = 3000, 750
CHARACTERS = 10_000_000
#: Rows with this remainder of crc32(doc_id) by 4 are never learned from.
HELD_OUT = (4, 2)
THRESHOLD = 0.3
#: Of class counts and letter counts; of the shared counts of words, which are 1 or 2.
DISCOUNT, SHARED_DISCOUNT = 0.75, 0.3
STRONGEST = 4
#: Words whose probabilities a task remembers; texts that are judged together, in characters.
REMEMBERED, TOGETHER = 100_000, 1 << 18
#: Letters of the longest letter n-gram.
LETTERS = 3
START = xxhash.xxh3_64_intdigest(b"\x00start")


def tokens(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct lower-cased words (the first stands for the end of a text), the words of all texts as places in them
    with an end behind each text, and how many tokens each text has."""
    numbers: dict[bytes, int] = defaultdict(itertools.count().__next__)  # its own __len__ would be a cycle that outlives the call
    numbers[b"\x00"]
    parts, sizes, stop = [], [], np.zeros(1, np.int64)
    for text in texts:
        words = text.encode().lower().split()
        parts += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), stop]
        sizes.append(len(words) + 1)
    return list(numbers), np.concatenate(parts), np.array(sizes, np.int64)


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def before(words: np.ndarray, sizes: np.ndarray, start) -> np.ndarray:
    """The word before each; ``start`` at the first of a text."""
    history = np.empty_like(words)
    history[1:] = words[:-1]
    history[np.cumsum(sizes) - sizes] = start
    return history


def letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words with an end mark behind each, and the word's place of every letter."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    return np.frombuffer(b"".join(w + b"\n" for w in words), np.uint8), np.repeat(np.arange(len(words), dtype=np.int32), sizes)


def grams(letter: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order of letter n-grams, hashes of the context and of context with letter, at every letter. Contexts
    reach no further than the word's start, which they see."""
    letter = letter.astype(np.uint64) + np.uint64(1)
    context = np.full(len(letter), 0x9E3779B97F4A7C15, np.uint64)
    for order in range(1, LETTERS + 1):
        if order > 1:
            back = order - 1
            far = np.full(len(letter), 300, np.uint64)
            same = owner[back:] == owner[:-back]
            far[back:][same] = letter[:-back][same]
            context = (context ^ far) * np.uint64(0xFF51AFD7ED558CCD)
            context ^= context >> np.uint64(29)
        gram = (context ^ (letter << np.uint64(48))) * np.uint64(0xC4CEB9FE1A85EC53)
        yield context + np.uint64(order), gram ^ gram >> np.uint64(31)


class Table:
    """Sums by a 64-bit key, a row for each class or a single one; 0 where a key is unknown. ``keys`` are sorted."""

    def __init__(self, keys: np.ndarray, *sums: np.ndarray):
        self.keys = keys
        self.sums = np.stack(sums)
        if not len(keys) or self.sums.max() < 2**16:
            self.sums = self.sums.astype(np.uint16)

    @classmethod
    def of(cls, rows: DataFrame) -> Table:
        """From a bounded table of keys (first column) and sums."""
        found = rows.orderBy(rows.columns[0]).toArrow()
        keys, *sums = (found[k].to_numpy() for k in found.column_names)
        order = np.argsort(keys.view(np.uint64))  # signed order before
        return cls(keys.view(np.uint64)[order], *(x[order] for x in sums))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((len(self.sums), len(keys)))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.sums[:, at].astype(float) * (self.keys[at] == keys)


def interpolated(count: np.ndarray, total: np.ndarray, kinds: np.ndarray, lower: np.ndarray, discount: float = DISCOUNT) -> np.ndarray:
    """One step of interpolated Kneser-Ney; where the history is unknown, the lower order's probability."""
    return np.where(total > 0, (np.maximum(count - discount, 0) + discount * kinds * lower) / np.maximum(total, 1), lower)


@dataclass
class Model:
    """Counts of both classes; toxic is row 0."""

    bigrams: Table
    histories: Table  # tokens behind a history (rows 0 and 1), distinct words behind it (rows 2 and 3)
    words: Table  # continuation counts: different words before a word
    letters: list[tuple[Table, Table]]  # by order: n-grams; their contexts' n-grams and distinct n-grams

    def __post_init__(self) -> None:
        held = self.words.sums > 0
        self.totals, self.kinds = self.words.sums.sum(axis=1, dtype=float), held.sum(axis=1, dtype=float)
        self.shared_total, self.shared_kinds = float(held.sum()), float(held.any(axis=0).sum())

    @classmethod
    def counted(cls, bigrams: DataFrame, letters: DataFrame) -> Model:
        """``bigrams``: h, w, key (of both), toxic, ordinary. ``letters``: order, context, gram, n."""
        seen = [F.sum((F.col(k) > 0).cast("int")).cast("int").alias(f"{k}_kinds") for k in ("toxic", "ordinary")]
        sums = [F.sum(k).cast("int").alias(k) for k in ("toxic", "ordinary")]
        pairs = Table.of(bigrams.select("key", F.col("toxic").cast("int"), F.col("ordinary").cast("int")))
        orders = []
        for order in range(1, LETTERS + 1):
            own = letters.where(F.col("order") == order)
            orders.append((Table.of(own.select("gram", "n")), Table.of(own.groupBy("context").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")))))
        return cls(pairs, Table.of(bigrams.groupBy("h").agg(*sums, *seen)), Table.of(bigrams.groupBy("w").agg(*seen)), orders)

    def spelled(self, vocabulary: list[bytes]) -> np.ndarray:
        """Probability of each word's spelling, as logarithms."""
        letter, owner = letters(vocabulary)
        p = np.full(len(owner), 1 / 257)
        for (table, contexts), (context, gram) in zip(self.letters, grams(letter, owner), strict=True):
            total, kinds = contexts(context)
            p = interpolated(table(gram)[0], total, kinds, p)
        return np.bincount(owner, np.log(p), len(vocabulary))

    def alone(self, vocabulary: list[bytes]) -> np.ndarray:
        """Probability of each word without its history in each class."""
        counts = self.words(hashed(vocabulary))
        spelled = np.exp(np.maximum(self.spelled(vocabulary), -600))
        shared = interpolated((counts > 0).sum(axis=0), np.full(len(vocabulary), self.shared_total), self.shared_kinds, spelled, SHARED_DISCOUNT)
        return interpolated(counts, self.totals[:, None] + np.zeros(len(vocabulary)), self.kinds[:, None], shared)

    def singles(self, vocabulary: list[bytes]) -> np.ndarray:
        """As ``alone``; those of words seen before are remembered."""
        if not hasattr(self, "places") or len(self.places) + len(vocabulary) > REMEMBERED:
            self.places: dict[bytes, int] = {}
            self.found = np.empty((2, max(REMEMBERED, len(vocabulary))))
        places = self.places
        new = [w for w in vocabulary if w not in places]
        if new:
            at = len(places)
            self.found[:, at : at + len(new)] = self.alone(new)
            places.update(zip(new, range(at, at + len(new)), strict=True))
        return self.found[:, np.fromiter(map(places.__getitem__, vocabulary), np.int64, len(vocabulary))]

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Per text the length-normalised log-likelihood ratio, of all of it and of its strongest words."""
        vocabulary, word, sizes = tokens(texts)
        hashes = hashed(vocabulary)
        lower = self.singles(vocabulary)
        single = np.log(lower[0] / lower[1])[word]
        start = np.array([START], np.uint64)
        behind = np.concatenate([self.histories(hashes), self.histories(start)], axis=1)
        h = before(word, sizes, len(vocabulary))
        key = mixed(np.append(hashes, start)[h], hashes[word])
        p = interpolated(self.bigrams(key), behind[:2, h], behind[2:, h], lower[:, word])
        ratio = np.log(p[0] / p[1])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort([-single, owner])
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(word)) - np.repeat(starts, sizes)
        best = single[order] * (place < STRONGEST)
        return np.stack([np.add.reduceat(ratio, starts) / sizes, np.add.reduceat(best, starts) / np.minimum(sizes, STRONGEST)], axis=1)


def make_room() -> None:
    """Gives back to the system what a reused worker has freed of earlier tasks but keeps."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


@dataclass
class Scorer:
    """A model, sent to the executors once, the weights of its curve, and the score that the curve rises to."""

    model: Broadcast
    weights: np.ndarray
    ceiling: float = 1.0

    def probability(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return self.ceiling / (1 + np.exp(-np.clip(self.weights[0] + self.model.value.evidence(texts) @ self.weights[1:], -30, 30)))


def mixed(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One key of two hashes."""
    key = (history ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xFF51AFD7ED558CCD) + word
    return (key ^ key >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, bias first, lightly held to zero."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (weight * (y - p)) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sampled(docs: DataFrame, labels: DataFrame, count_rows: int, curve_rows: int, characters: int) -> tuple[DataFrame | None, dict[int, int]]:
    """The rows to learn from (``text``, ``toxic``, ``counted``) as a written table, and the labelled rows of each class.

    Rows come by the hash of their id; null labels and null ids are no labels, of several labels of one id the highest
    counts, and of several texts of one id the lowest. The driver sees ids and lengths of the sample.
    """
    modulus, left_out = HELD_OUT
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    usable = known.where(remainder(F.col("doc_id"), modulus) != left_out).where("toxic in (0, 1)")
    lengths = whole(docs).groupBy("doc_id").agg(F.min(F.length("text")).alias("size"))
    usable = written(usable.join(lengths, "doc_id").withColumn("h", F.xxhash64("doc_id")), "toxicity-labels")
    share = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = []
    for value in (1, 0):
        rows = usable.where(F.col("toxic") == value).orderBy("h", "doc_id").limit(count_rows + curve_rows).select("doc_id", "size").collect()
        fits, size = [], 0
        for r in rows:
            if size + r["size"] <= characters:
                fits.append(r["doc_id"])
                size += r["size"]
        part = count_rows / (count_rows + curve_rows)
        picked += [(doc, value, k < part * len(fits)) for k, doc in enumerate(fits)]
    if not picked:
        return None, share
    sample = docs.sparkSession.createDataFrame(picked, "doc_id long, toxic int, counted boolean")
    texts = whole(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic", "counted").agg(F.min_by("text", F.struct(F.length("text"), "text")).alias("text"))
    return written(texts, "toxicity-sample"), share


def counts(sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The class bigrams and the shared letter n-grams of distinct words, as ``Model.counted`` takes them."""

    def words_in(block: pa.Table) -> Iterator[pa.RecordBatch]:
        make_room()
        vocabulary, word, sizes = tokens(block["text"].to_pylist())
        hashes = np.append(hashed(vocabulary), np.uint64(START))
        label = np.repeat(block["toxic"].to_numpy(), sizes)
        frame = pd.DataFrame({"h": before(word, sizes, len(vocabulary)), "w": word, "toxic": label == 1, "ordinary": label == 0})
        frame = frame.groupby(["h", "w"], as_index=False, sort=False).sum()
        h, w = hashes[frame["h"].to_numpy()], hashes[frame["w"].to_numpy()]
        columns = [h.view(np.int64), w.view(np.int64), mixed(h, w).view(np.int64), *(frame[k].to_numpy(np.int64) for k in ("toxic", "ordinary"))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "w", "key", "toxic", "ordinary"])

    def distinct(block: pa.Table) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(tokens(block["text"].to_pylist())[0], pa.binary())], names=["word"])

    def spellings(block: pa.Table) -> Iterator[pa.RecordBatch]:
        letter, owner = letters(block["word"].to_pylist())
        for order, (context, gram) in enumerate(grams(letter, owner), 1):
            found, first, n = np.unique(gram, return_index=True, return_counts=True)
            columns = [np.full(len(found), order), context[first].view(np.int64), found.view(np.int64), n.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["order", "context", "gram", "n"])

    pairs = over_blocks(sample, words_in, "h long, w long, key long, toxic long, ordinary long", limit=8 * TOGETHER)
    pairs = written(pairs.groupBy("h", "w", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "toxicity-bigrams")
    words = over_blocks(sample, distinct, "word binary").distinct()
    spelled = over_blocks(words, spellings, "order long, context long, gram long, n long", sized_by="word", limit=4 * TOGETHER)
    return pairs, written(spelled.groupBy("order", "context", "gram").agg(F.sum("n").alias("n")), "toxicity-letters")


def fit(docs: DataFrame, labels: DataFrame, count_rows: int = COUNT_ROWS, curve_rows: int = CURVE_ROWS, characters: int = CHARACTERS) -> Scorer | None:
    """The model of ``labels.toxic``, learned from at most ``count_rows + curve_rows`` labelled rows of each class that
    have at most ``characters``. None if no sampled document bears a label.

    A curve is fitted where both classes have rows for it. Where one has none, because it has fewer than five labels or
    none at all, nothing tells how far apart the classes lie: texts are then ordered by the likelihood ratio of the whole
    text, below the threshold, so none is predicted toxic."""
    small_batches(docs.sparkSession)
    sample, share = sampled(docs, labels, count_rows, curve_rows, characters)
    if sample is None:
        return None
    pairs, spelled = counts(sample.where("counted"))
    shared = docs.sparkSession.sparkContext.broadcast(Model.counted(pairs, spelled))

    def judge(block: pa.Table) -> Iterator[pa.RecordBatch]:
        make_room()
        x = shared.value.evidence(block["text"].to_pylist())
        yield pa.RecordBatch.from_arrays([block["toxic"].combine_chunks(), *(pa.array(np.ascontiguousarray(x[:, k])) for k in range(2))], names=["toxic", "a", "b"])

    seen = over_blocks(sample.where("not counted"), judge, "toxic int, a double, b double", limit=8 * TOGETHER).toArrow()
    y = seen["toxic"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return Scorer(shared, np.array([0.0, 1.0, 0.0]), THRESHOLD)
    order = np.lexsort([seen[k].to_numpy() for k in "ab"] + [y])
    x, y = np.stack([seen[k].to_numpy() for k in "ab"], axis=1)[order], y[order]
    weight = np.where(y == 1, share.get(1, 0) / max(y.sum(), 1), share.get(0, 0) / max((1 - y).sum(), 1))
    return Scorer(shared, fit_curve(x, y, weight / weight.mean()))


def judged(texts: pa.Array, scorer: Scorer) -> np.ndarray:
    """The toxicity of each text, 0 to 1, some ``TOGETHER`` characters at a time. A null text counts as empty."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    group = np.cumsum(sizes) // TOGETHER
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(texts)]
    parts = [scorer.probability(pc.fill_null(texts.slice(x, y - x), "").to_pylist()) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    return np.concatenate(parts) if parts else np.empty(0)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    A null or empty text is scored by its end alone. A text is judged as a whole however long it is. Rows that repeat a
    text have its score; of rows that share an id but not the text, each has its own. A null id is no label and not held
    out. Score 0 if there is nothing to learn from, and below the threshold if a class has too few labels (``fit``). An empty table gives no rows. Of ``docs`` only ``doc_id`` and
    ``text`` are read, of ``labels`` only ``doc_id`` and ``toxic``.
    """
    scorer = fit(docs, labels)
    if scorer is None:
        scored = whole(docs).select("doc_id", F.lit(0.0).alias("score"))
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            make_room()
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(judged(batch.column("text"), scorer))], names=["doc_id", "score"])

        scored = whole(docs).mapInArrow(run, "doc_id long, score double")
    modulus, left_out = HELD_OUT
    return scored.select("doc_id", (remainder(F.col("doc_id"), modulus) == left_out).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, with their own columns, whatever their names. Nulls, empty and repeated
    rows as of ``toxicity``."""
    scorer = fit(docs, labels)
    if scorer is None:
        return docs
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            yield batch.filter(pa.array(judged(batch.column(at), scorer) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
