"""Quality classifier taught by weak labels.

Overlapping heuristic labellers (the quality rules) vote on every document; expectation-maximisation over the patterns
of their votes estimates the labellers' accuracies and each document's probability of being good. These posteriors are
the labels of a linear scorer over hashed features of a text, fitted on a bounded sample of documents. The scorer sees
words, word shapes and repetitions and so judges also where all labellers abstain.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_blocks, whole, written
from .quality_rules import estimated, measured, posteriors, voted

#: Documents that the scorer is fitted on, and the characters of their words: the bounds of the sample.
SAMPLE, CHARACTERS = 6000, 20_000_000
#: Text bytes whose features are worked out together.
TOGETHER = 8 << 20
DIMENSIONS = 1 << 15
STEPS = 120
KEPT_FROM = 0.5
LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of whole texts and their values, the square roots of their shares of all features of the text.

    Words are numbered over all the texts; what is known of a word (its lower case and its shape) is worked out once.
    """
    numbers: dict[str, int] = defaultdict()
    numbers.default_factory = lambda: len(numbers)
    tokens = []
    for text in texts:
        words = text.split()
        tokens.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    names: dict[str, int] = defaultdict()
    names.default_factory = lambda: len(names)
    lowered = np.fromiter((names[f"w:{w.lower()}"] for w in numbers), np.int64, len(numbers))
    shaped = np.fromiter((names[f"s:{DIGITS.sub('0', LETTERS.sub('a', w))}"] for w in numbers), np.int64, len(numbers))
    found = []
    for text, token in zip(texts, tokens, strict=True):
        kinds, counts = np.unique(np.concatenate([lowered[token], shaped[token]]), return_counts=True)
        pairs = token[:-1] * len(numbers) + token[1:]
        lines = [line for line in text.split("\n") if line.strip()]
        more = {
            "again": int((token[1:] == token[:-1]).sum()), "pair again": len(pairs) - len(np.unique(pairs)), "line": len(lines),
            "line again": len(lines) - len(set(lines)), f"size:{len(token).bit_length()}": 1 + len(token),
        }
        found.append((np.append(kinds, [names[k] for k in more]), np.append(counts, list(more.values())).astype(np.float32)))
    hashed = np.fromiter((zlib.crc32(k.encode("utf-8", "replace")) % DIMENSIONS for k in names), np.int32, len(names))
    return [(hashed[at], np.sqrt(n / max(n.sum(), 1))) for at, n in found]


def fit(at: list[np.ndarray], values: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Weights and bias (last) of a logistic scorer of soft labels, by AdaGrad over the whole sample."""
    row = np.repeat(np.arange(len(at)), [len(x) for x in at])
    column, value = np.concatenate(at), np.concatenate(values).astype(float)
    w, bias = np.zeros(DIMENSIONS), 0.0
    past, past_bias = np.full(DIMENSIONS, 1e-6), 1e-6
    weight = np.where(target < 0.5, 0.5 / max((target < 0.5).mean(), 1e-3), 0.5 / max((target >= 0.5).mean(), 1e-3))
    weight /= weight.sum()
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column] * value, len(at)) + bias, -30, 30)))
        wrong = weight * (p - target)
        slope = np.bincount(column, wrong[row] * value, DIMENSIONS) + 1e-5 * w
        past += slope**2
        w -= 0.5 * slope / np.sqrt(past)
        past_bias += wrong.sum() ** 2
        bias -= 0.5 * wrong.sum() / np.sqrt(past_bias)
    return np.append(w, bias)


def scored(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, higher is better) and ``kept`` of every row.

    A null text is empty; empty texts are scored like any. Repeated rows are scored alike. Of an empty table nothing is
    learned and nothing returned. Other columns than ``doc_id`` and ``text`` are not read. Texts of any length are scored
    whole; the sample takes documents in the order of their ids' hashes, ties by id, up to ``sample`` of them and
    ``CHARACTERS``; a document that would go beyond is not learned from.
    """
    texts = whole(docs)
    votes = written(voted(measured(texts)).drop("text"), "labellers")
    shares, says = estimated(votes)
    picked = votes.where("doc_id is not null").withColumn("good", posteriors(shares, says)[0])
    picked = picked.groupBy("doc_id").agg(F.min("good").alias("good"), F.sum(F.col("word_chars") + F.col("n_words")).alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    room, sampled = CHARACTERS, []
    for r in picked:
        if r["size"] <= room:
            sampled.append((r["doc_id"], r["good"]))
            room -= r["size"]
    if not sampled:
        return texts.select("doc_id", F.lit(1.0).alias("score"), F.lit(True).alias("kept"))
    chosen = texts.join(F.broadcast(docs.sparkSession.createDataFrame(sampled, "doc_id long, good double")), "doc_id")

    def featured(block: pa.Table) -> Iterator[pa.RecordBatch]:
        both = features(block["text"].to_pylist())
        columns = [pa.array([a for a, _ in both], pa.list_(pa.int32())), pa.array([v for _, v in both], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays([block["doc_id"].combine_chunks(), block["good"].combine_chunks(), *columns], names=["doc_id", "good", "at", "values"])

    rows = over_blocks(chosen, featured, "doc_id long, good double, at array<int>, values array<float>", limit=TOGETHER).toArrow().sort_by("doc_id")
    at, values = ([np.array(x) for x in rows[k].to_pylist()] for k in ("at", "values"))
    weights = fit(at, values, rows["good"].to_numpy())

    def score(block: pa.Table) -> Iterator[pa.RecordBatch]:
        raw = np.array([weights[where] @ value + weights[-1] for where, value in features(block["text"].to_pylist())])
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        yield pa.RecordBatch.from_arrays([block["doc_id"].combine_chunks(), pa.array(p), pa.array(p >= KEPT_FROM)], names=["doc_id", "score", "kept"])

    return over_blocks(texts, score, "doc_id long, score double, kept boolean", limit=TOGETHER)
