"""Katz backoff against plain counting, with a history for every word."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from shelfwise.llm import katz


def plain(texts):
    tokens = {k: [*t.split(), None] for k, t in texts}
    learned = [t for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    one, two = Counter(w for t in learned for w in t), defaultdict(Counter)
    for t in learned:
        for h, w in zip(["<start>", *t], t, strict=False):
            two[h][w] += 1
    of = lambda counts: np.bincount(np.minimum(list(counts), katz.LARGE + 2), minlength=katz.LARGE + 3)[1 : katz.LARGE + 2]
    ratios = katz.discounts(of(c for x in two.values() for c in x.values()))
    unigrams = katz.Unigrams.of(of(one.values()), sum(one.values()), len(one))
    single = lambda w: float(unigrams(np.array([one[w]]))[0])
    kept = lambda c: ratios[min(c, katz.LARGE + 1)] * c

    def step(h, w):
        if h not in two:
            return single(w)
        n, held = sum(two[h].values()), sum(map(kept, two[h].values()))
        left = max(1 - held / n, 1 / (n + 2))
        return (1 - left) * kept(two[h][w]) / held if two[h][w] else single(w) * left / max(1 - sum(map(single, two[h])), unigrams.unknown / 2)

    return {k: sum(math.log10(step(h, w)) for h, w in zip(["<start>", *t], t, strict=False)) for k, t in tokens.items()}


def test_every_word_is_a_history_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(katz, "FREQUENT", 2)
    classes, words = defaultdict(list), [f"w{k}" for k in range(2000)]
    for w in words:
        classes[xxhash.xxh3_64_intdigest(w.encode()) % 32767].append(w)
    same = next(ws for ws in classes.values() if len(ws) > 1)[:2]  # were pooled
    random.seed(5)
    names = ["often", "oftener", *same, *words[:23]]
    texts = [(k, " ".join(random.choices(names, [90, 90, 20, 20, *range(1, 24)], k=k % 30))) for k in range(150)]
    texts += [(1000 + k, f"{same[0]} {names[5]} {same[0]} {names[6]}") for k in range(9)] + [(2000 + k, f"{same[1]} {names[7]} new {same[1]} {names[5]}") for k in range(9)]
    want = plain(texts)
    found = {r["doc_id"]: r["score"] for r in katz.scores(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 * max(1, -want[k]) for k in want)
