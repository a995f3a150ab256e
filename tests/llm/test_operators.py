"""Each operator against brute force or another library, and on odd inputs."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import bpe, components, embeddings, jaccard, katz, packing, pii, quality_classifier, quality_rules, toxicity, wavelet

from .conftest import TEXTS

SPACE = "[^\x20\x09-\x0d]+"
lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
words = lambda s: re.findall(SPACE, s or "")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# 1 Katz


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_katz_base_scores(request, which):
    df = request.getfixturevalue(which)
    docs = texts_of(df)
    tokens = lambda t: [*words(lower(t)), None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = collections.Counter(w for d, t in docs if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(((d or -1), held(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 5)) for d, t in docs)
    rows = katz.scores(df).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def held_out_ids(n):
    return list(itertools.islice((k for k in itertools.count(10_000) if zlib.crc32(str(k).encode()) % 7 == 2), n))


def test_katz_is_normalised(spark):
    """The probabilities of all texts of up to 6 words sum to nearly 1: what is left are longer texts."""
    random.seed(1)
    texts = [(k, " ".join(random.choices("aabc", k=random.choice([0, 0, 1, 1, 2, 3])))) for k in range(300)]
    every = [" ".join(t) for n in range(7) for t in itertools.product(["a", "b", "c", "unknown"], repeat=n)]
    probes = list(zip(held_out_ids(len(every)), every, strict=True))
    rows = katz.scores(spark.createDataFrame(texts + probes, "doc_id long, text string")).where("doc_id >= 10000").collect()
    assert len(rows) == len(every) and 0.98 < sum(10 ** r["score"] for r in rows) < 1 + 1e-9


def test_katz_beats_the_base_where_words_follow_each_other(spark):
    random.seed(1)
    texts = []
    for k in range(200):
        walk = [random.randrange(30)]
        while len(walk) < 20:
            walk.append((7 * walk[-1] + 3) % 30 if random.random() < 0.7 else random.randrange(30))
        texts.append((k, " ".join(f"w{x}" for x in walk)))
    held = katz.scores(spark.createDataFrame(texts, "doc_id long, text string")).where("held_out").collect()
    assert held and sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)


def test_katz_scores_do_not_depend_on_partitions(spark, documents, monkeypatch):
    monkeypatch.setattr(katz, "FREQUENT", 300)  # far fewer than there are words
    found = [{r["doc_id"]: r["score"] for r in katz.scores(documents.repartition(n)).collect()} for n in (1, 8, 40)]
    for other in found[1:]:
        assert found[0].keys() == other.keys() and all(abs(found[0][k] - other[k]) < 1e-6 for k in other)


def test_katz_discounts():
    d = katz.discounts(np.array([100, 40, 20, 10, 5, 2]))
    assert d[0] == d[-1] == 1 and all(0 < x < 1 for x in d[1:6])
    u = katz.Unigrams.of(np.array([100, 40, 20, 10, 5, 2]), 400, 177)
    seen = [1] * 100 + [2] * 40 + [3] * 20 + [4] * 10 + [5] * 5 + [400 - 325] * 1
    total = sum(seen)
    u = katz.Unigrams.of(np.array([100, 40, 20, 10, 5, 0]), total, len(seen))
    assert abs(u(np.array(seen)).sum() + u.unknown - 1) < 1e-9


def test_katz_of_nothing(none):
    assert katz.scores(none).count() == 0


# 2 toxicity


def test_toxicity_learns_and_holds_out(spark, odd, none):
    random.seed(2)
    common = [f"{a}{b}" for a in ("ba", "ko", "li", "mu") for b in ("ra", "te", "so")]
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        body = random.choices(common, k=40)
        if bad:
            body[7], body[21], body[33] = random.choices(["vileling", "vilelous", "vileler"], k=3)
        docs.append((k, " ".join(body)))
        labels.append((k, int(bad)))
    labelled = spark.createDataFrame([*labels, (9999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labelled).collect()}
    held = [k for k, _ in docs if rows[k]["held_out"]]
    assert {rows[k]["held_out"] for k, _ in docs} == {True, False}
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert np.mean([rows[k]["predicted"] == dict(labels)[k] for k in held]) > 0.95
    learned = spark.createDataFrame(docs, "doc_id long, text string")
    assert toxicity.toxicity(none, labelled).count() == 0
    assert toxicity.toxicity(odd, labelled.limit(0)).select("score").distinct().collect()[0][0] == 0.0
    assert toxicity.harmless(learned, labelled).count() < 330 and toxicity.harmless(odd, labelled.limit(0)).columns == odd.columns


@pytest.mark.parametrize(("toxic", "ordinary"), [(1, 1), (2, 2), (4, 4), (5, 0), (0, 5), (40, 2)])
def test_toxicity_of_few_labels_flags_nothing(spark, documents, toxic, ordinary):
    ids = [r["doc_id"] for r in documents.select("doc_id").orderBy("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    labels = spark.createDataFrame([(d, 1) for d in ids[:toxic]] + [(d, 0) for d in ids[toxic : toxic + ordinary]], "doc_id long, toxic int")
    rows = toxicity.toxicity(documents, labels).collect()
    assert len(rows) == documents.count() and not any(r["predicted"] for r in rows) and all(0 <= r["score"] < 0.3 for r in rows)
    assert len({r["score"] for r in rows}) > 20  # still an order
    assert toxicity.harmless(documents, labels).count() == len(rows)


def test_toxicity_of_five_labels_each_keeps_the_corpus(spark, documents):
    ids = [r["doc_id"] for r in documents.select("doc_id").orderBy("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    labels = spark.createDataFrame([(d, k % 2) for k, d in enumerate(ids[:10])], "doc_id long, toxic int")
    assert 0 < toxicity.harmless(documents, labels).count() <= documents.count()


def test_toxicity_probabilities_are_kneser_ney(spark):
    """Evidence of the model against formulas over plain counts."""
    random.seed(22)
    docs = [(k, int(k % 3 == 0), " ".join(random.choices(["abc", "abd", "b", "vile", "é", "abcd", f"x{k % 5}"], k=random.randint(0, 9)))) for k in range(30)]
    model = toxicity.Model.counted(*toxicity.counts(spark.createDataFrame(docs, "doc_id long, toxic int, text string").repartition(3)))
    bigrams = [collections.Counter(), collections.Counter()]
    for _, toxic, text in docs:
        w = text.split()
        bigrams[1 - toxic].update(zip(["^", *w], [*w, "\x00"]))
    vocabulary = sorted({w for c in bigrams for _, w in c})
    spell = [collections.Counter() for _ in range(3)]
    spelled_as = lambda w: [256, 256, *w.encode(), 10]
    context = lambda x, k, n: tuple(x[max(k - n, 1) : k])  # noqa: E731  the first mark is seen where the context reaches the start
    for w in vocabulary:
        x = spelled_as(w)
        for k in range(2, len(x)):
            for n in range(3):
                spell[n][context(x, k, n), x[k]] += 1

    def interpolate(count, total, kinds, lower, discount=0.75):
        return (max(count - discount, 0) + discount * kinds * lower) / total if total else lower

    def spelling(w):
        x, out = spelled_as(w), 1.0
        for k in range(2, len(x)):
            p = 1 / 257
            for n in range(3):
                own = {y: c for (h, y), c in spell[n].items() if h == context(x, k, n)}
                p = interpolate(own.get(x[k], 0), sum(own.values()), len(own), p)
            out *= p
        return out

    classes = [{w: sum(x == w for _, x in c) for w in vocabulary} for c in bigrams]
    shared = {w: sum(c[w] > 0 for c in classes) for w in vocabulary}

    def single(c, w):
        lower = interpolate(shared.get(w, 0), sum(shared.values()), len(shared), spelling(w), 0.3)
        return interpolate(classes[c].get(w, 0), sum(classes[c].values()), sum(v > 0 for v in classes[c].values()), lower)

    def pair(c, h, w):
        own = {y: n for (x, y), n in bigrams[c].items() if x == h}
        return interpolate(own.get(w, 0), sum(own.values()), len(own), single(c, w))

    probes = ["", "vile", "abc abd b", "new abq vile x1 x1 é", "b b b b b b b"]
    found = model.evidence(probes)
    for text, (whole, best) in zip(probes, found, strict=True):
        w = text.split()
        ratios = [math.log(pair(0, h, x) / pair(1, h, x)) for h, x in zip(["^", *w], [*w, "\x00"])]
        ranked = sorted((math.log(single(0, x) / single(1, x)) for x in [*w, "\x00"]), reverse=True)[:4]
        assert abs(whole - sum(ratios) / len(ratios)) < 1e-9 and abs(best - sum(ranked) / len(ranked)) < 1e-9


def test_toxicity_sample_is_bounded(spark, documents):
    labels = documents.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample, share = toxicity.sampled(documents, labels, 8, 4, 20_000)
    rows = sample.collect()
    for value in (0, 1):
        own = [r for r in rows if r["toxic"] == value]
        assert 0 < len(own) <= 12 and sum(len(r["text"]) for r in own) <= 20_000 and share[value] > len(own)
    assert not any(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)


# 3 BPE


def test_bpe_is_that_of_the_library(odd, documents, none):
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, documents):
        expected = sorted((d or -1, len(i := library.encode_ordinary(t or "")), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in texts_of(df))
        assert sorted((r["doc_id"] or -1, *r[1:]) for r in bpe.round_trip(df).collect()) == expected
    assert sorted(r["text"] for r in bpe.decode(bpe.encode(odd)).collect()) == sorted(t or "" for _, t in texts_of(odd))
    assert bpe.round_trip(none).count() == 0


def test_bpe_replay_of_random_pieces():
    m = bpe.merges(public_tokenizers.path(bpe.VOCABULARY))
    random.seed(3)
    pieces = [bytes(random.choices(b"abnst e", k=random.randint(1, 40))) for _ in range(3000)] + [b"a" * k for k in range(1, 70)]
    ids, counts = bpe.replayed(pieces, m)
    for piece, found in zip(pieces, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert found.tolist() == ([m.ranks[piece]] if piece in m.ranks else m.alone(piece))


# 4 Jaccard


def brute_classes(docs, n, percent):
    sets = {}
    for d, t in docs:
        w = words(lower(t))
        sets[d] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_is_brute_force(spark, n, percent):
    random.seed(n)
    passage = [f"p{k}" for k in range(40)]
    docs = []
    for group in range(25):
        base = [f"g{group}_{random.randint(0, 60)}" for _ in range(random.choice([3, 10, 60, 150]))]
        for _ in range(random.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(random.choice([0, 1, 2, 6])):
                copy[random.randrange(len(copy))] = f"z{random.randint(0, 9)}"
            docs.append((len(docs), " ".join(copy + (passage if random.random() < 0.2 else []))))
    rows = jaccard.classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), n, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_classes(docs, n, percent)


def test_jaccard_on_odd_rows(odd, none):
    rows = jaccard.classes(odd).collect()
    assert len(rows) == odd.count() and jaccard.classes(none).count() == 0
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert by[0] == (0, 0) and by[1] == (0, 1) and by[3] == (1, 3) and by[5] == by[6] == (2, 5)
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [k for k in range(len(TEXTS)) if k != 6]


def test_jaccard_of_rows_that_share_an_id(spark):
    base = [f"w{k}" for k in range(60)]
    near = [*base[:30], "other", *base[31:]]
    rows = [(1, " ".join(base)), (1, "something else that is quite short"), (2, " ".join(near)), (2, "alone with some words of its own"), (3, " ".join(base)), (3, " ".join(base)), (4, ""), (None, " ".join(base))]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string").repartition(3)
    found = collections.Counter((r["doc_id"], r["component_id"]) for r in jaccard.classes(df, 4, 80).collect())
    assert found == {(1, 1): 2, (2, 1): 1, (2, 2): 1, (3, 1): 2, (4, 4): 1, (None, None): 1}
    kept = jaccard.one_of_each(df, 4, 80)
    assert kept.columns == df.columns
    expected = collections.Counter([rows[0], rows[1], rows[3], rows[6], rows[7]])
    assert collections.Counter((r["doc_id"], r["text"]) for r in kept.collect()) == expected


def test_jaccard_in_pieces(spark, monkeypatch):
    """Lists in pieces and parts, and chains of few sets, change nothing."""
    monkeypatch.setattr(jaccard, "PIECE", 7)
    monkeypatch.setattr(jaccard, "CHAIN", 3)
    random.seed(44)
    base = [f"b{k}" for k in range(80)]
    docs = []
    for k in range(60):
        copy = list(base)
        for _ in range(random.choice([1, 2, 3])):
            copy[random.randrange(80)] = f"z{random.randint(0, 400)}"
        docs.append((k, " ".join(copy)))
    rows = jaccard.classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_classes(docs, 4, 85)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert found == {k: 0 for k in range(61)} | {100: 100, 101: 100}


# 5 PII


def test_pii_spans(odd, none):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    checks = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")), "card": lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(d), "phone": lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15}
    random.seed(5)
    plain = lambda text: [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text) if checks[k](m[0])]
    for text in [*("".join(random.choices("ab.@-_+%1234567890 ()", k=80)) for _ in range(3000)), *filter(None, TEXTS), "a@b.c@d.e", "1.2.3.4.5.6.7.8", "4111-1111 1111 1111 1"]:
        assert pii.base_spans(text) == plain(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    rows = pii.detect(odd).collect()
    assert len(rows) == odd.count() and pii.detect(none).count() == 0
    digests = collections.Counter(hashlib.sha256(pii.joined(plain(t or "")).encode()).hexdigest() for _, t in texts_of(odd))
    assert collections.Counter(r["base_sha256"] for r in rows) == digests
    for kind in pii.KINDS:
        assert sum(r[f"n_{kind}"] for r in rows) == sum(k == kind for _, t in texts_of(odd) for k, _, _ in plain(t or ""))
    masked = {r["doc_id"]: r["text"] for r in pii.masked(odd).collect()}
    assert masked[8] == "mail me: <email> or <phone> now" and masked[0] is None and pii.masked(odd).columns == odd.columns


def test_pii_of_long_digit_runs_and_repeated_ids(spark):
    long_run = "0" * 5000
    assert pii.base_spans(f"{long_run}.1.2.3") == [("ip", 0, 5006)] and pii.base_spans(f"{long_run}.1.2.300") == []
    assert pii.base_spans("9" * 5000 + ".1.2.3") == [] and pii.base_spans("0000.0.0.255 x") == [("ip", 0, 12)]
    rows = [(1, "zzzz yyyy a@b.cd xxxx"), (1, "uuuu tttt +49 30 123456 and more"), (None, f"{long_run}.1.2.3"), (None, "a@b.cd"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = collections.Counter((r["doc_id"], r["text"]) for r in pii.masked(df).collect())
    assert texts == collections.Counter([(1, "zzzz yyyy <email> xxxx"), (1, "uuuu tttt <phone> and more"), (None, "<ip>"), (None, "<email>"), (2, None)])
    assert collections.Counter((r["doc_id"], r["spans"]) for r in pii.detect(df).collect()) == collections.Counter([(1, "email:10:16"), (1, "phone:10:23"), (None, "ip:0:5006"), (None, "email:0:6"), (2, "")])


def test_pii_finds_revealing_terms(spark):
    filler = [f"word{k}" for k in range(50)]
    random.seed(6)
    docs = [(k, " ".join([*random.choices(filler, k=20), "Blackwood", "the", f"boss{k % 2}@corp.example.com", *random.choices(filler, k=20)])) for k in range(0, 40, 2)]
    docs += [(1000 + k, " ".join(["the", *random.choices(filler, k=30)])) for k in range(200)]
    rows = {r["doc_id"]: r["spans"] for r in pii.detect(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    text = dict(docs)[0]
    assert f"term:{text.index('Blackwood')}:{text.index('Blackwood') + 9}" in rows[0] and all(not rows[1000 + k] for k in range(200))
    assert text[text.index(" the ") :] not in rows[0] and "Blackwood" not in pii.masked(spark.createDataFrame(docs, "doc_id long, text string")).where("doc_id = 0").first()["text"]


def test_pii_terms_are_found_far_away_and_taken_out_everywhere(spark):
    random.seed(7)
    filler = lambda k: " ".join(random.choices([f"word{j}" for j in range(50)], k=k))
    docs = [(k, f"Thornfield {filler(15)} reach {filler(9)} ann@corp.example.com {filler(9)} (Thornfield). {filler(k)}") for k in range(2)]
    docs += [(2, f"{filler(20)} Thornfield, {filler(3)}"), (3, f"Hapax {filler(9)} bob@corp.example.com {filler(9)}")]
    docs += [(1000 + k, f"reach {filler(30)}") for k in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r["spans"] for r in pii.detect(df).collect()}
    for doc, text in docs:
        places = [f"term:{m.start()}:{m.end()}" for m in re.finditer("Thornfield", text)]
        assert [x for x in rows[doc].split(",") if x.startswith("term")] == places and len(places) == (2, 2, 1, 0)[min(doc, 3)]
    texts = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    assert not any("Thornfield" in t for t in texts.values()) and "Hapax" in texts[3] and "<email>" in texts[0] and "reach" in texts[0]


# 6 and 7 quality


def measures(text):
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in range(3)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), lines, len(covered)


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_quality_measures(request, which):
    df = request.getfixturevalue(which)
    rows = quality_rules.quality(df).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows) == sorted((d or -1, *measures(t)) for d, t in texts_of(df))
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in rows)
    assert quality_rules.good(df).columns == df.columns


def plain_votes(text: str | None) -> list[int]:
    """Votes of the rules, from the plain measures of a text."""
    w, body = words(text), text or ""
    n, chars, symbols, twice, repeated = measures(text)
    lines = sum(bool(words(line)) for line in body.split("\n"))
    stops = sum(body.count(c) for c in ".!?")
    plain = sum(bool(regex.fullmatch(r"\p{L}+[.,;:!?]?", x)) for x in w)
    distinct = len(set(w))
    bad_good = [
        (n < 20, n >= 80),
        (stops * 60 < n, n <= stops * 30 and stops * 3 <= n),
        (symbols * 10 > n, symbols * 50 <= n),
        (plain * 10 < 7 * n, plain * 10 >= 9 * n),
        (not 2 * n <= chars <= 12 * n, 3 * n <= chars <= 9 * n),
        (twice * 5 > lines, not twice),
        (repeated * 10 > 3 * n, repeated * 12 <= n),
        (distinct * 5 < n, distinct * 3 >= n),
    ]
    return [-1 if bad else int(good) for bad, good in bad_good]


def plain_posteriors(votes: np.ndarray) -> np.ndarray:
    """Each document's probability of being good, by expectation-maximisation over single documents."""
    own = np.array([[way == rule[1] for rule in quality_rules.RULES] for way in quality_rules.WAYS])
    chances = np.vstack([np.full((1, len(own[0])), 0.95), np.where(own, 0.3, 0.85)])
    low = np.vstack([np.full((1, len(own[0])), 0.9), np.where(own, 0.0001, 0.3)])
    high = np.vstack([np.full((1, len(own[0])), 0.9999), np.where(own, 0.6, 0.98)])
    shares = np.array([0.85, 0.05, 0.05, 0.05])

    def posterior() -> np.ndarray:
        chance = np.where(votes[:, None] > 0, chances, np.where(votes[:, None] < 0, 1 - chances, 1.0))
        joint = shares * chance.prod(axis=2)
        return joint / joint.sum(axis=1, keepdims=True)

    for _ in range(quality_rules.ROUNDS):
        p = posterior()
        shares = (p.sum(axis=0) + 1) / (len(votes) + len(shares))
        chances = np.clip((p.T @ (votes > 0) + 1) / (p.T @ (votes != 0) + 2), low, high)
    return posterior()[:, 0]


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_quality_posteriors_are_brute_force(request, which):
    df = request.getfixturevalue(which)
    texts = texts_of(df)
    posterior = plain_posteriors(np.array([plain_votes(t) for _, t in texts]))
    failed = [len(words(t)) < 50 or 100 * measures(t)[4] > 50 * len(words(t)) for _, t in texts]
    kept = [not f and p >= 0.5 for f, p in zip(failed, posterior, strict=True)]
    rows = quality_rules.quality(df).collect()
    key = lambda r: (-1 if r[0] is None else r[0], round(r[1], 6), r[2])
    got = sorted([(r["doc_id"], round(r["posterior"], 9), r["kept"]) for r in rows], key=key)
    want = sorted([(d, round(float(p), 9), k) for (d, _), p, k in zip(texts, posterior, kept, strict=True)], key=key)
    assert [(d, k) for d, _, k in got] == [(d, k) for d, _, k in want]
    assert np.allclose([p for _, p, _ in got], [p for _, p, _ in want], atol=1e-8)
    stay = sorted(r["doc_id"] or -1 for r in quality_rules.good(df).select("doc_id").collect())
    assert stay == sorted(d or -1 for (d, _), k in zip(texts, kept, strict=True) if k)
    clash = df.withColumns({"__quality_0_n_words": F.lit(1), "__quality_words": F.lit("x"), "n_words": F.lit(2), "votes": F.lit(3)})
    found = quality_rules.good(clash)
    assert found.columns == clash.columns and sorted(r["doc_id"] or -1 for r in found.collect()) == stay


def test_quality_agrees_with_labels(spark, documents, none):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rules = quality_rules.quality(documents).where("not base_failed").join(labels, "doc_id")
    assert rules.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("double"))).first()[0] > 0.97
    scored = quality_classifier.scored(documents).join(labels, "doc_id")
    assert scored.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("double"))).first()[0] > 0.9
    assert quality_rules.quality(none).count() == 0 and quality_classifier.scored(none).count() == 0


def test_classifier_features_are_counts_of_words_shapes_and_repeats():
    texts = ["", "a A b12 a\n\na A b12 a\nx", "one", "r r r r"]
    for text, (at, value) in zip(texts, quality_classifier.features(texts), strict=True):
        w, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        counts = collections.Counter([f"w:{x.lower()}" for x in w] + ["s:" + re.sub(r"\d+", "0", re.sub(r"[^\W\d_]+", "a", x)) for x in w])
        pairs = list(zip(w, w[1:]))
        counts.update({"again": sum(a == b for a, b in pairs), "pair again": len(pairs) - len(set(pairs)), "line": len(lines), "line again": len(lines) - len(set(lines)), f"size:{len(w).bit_length()}": 1 + len(w)})
        dense, expected = np.zeros(quality_classifier.DIMENSIONS), np.zeros(quality_classifier.DIMENSIONS)
        np.add.at(dense, at, value)
        for k, n in counts.items():
            expected[zlib.crc32(k.encode()) % quality_classifier.DIMENSIONS] += math.sqrt(n / sum(counts.values()))
        assert np.allclose(dense, expected, atol=1e-6)


def test_classifier_sample_is_bounded_by_characters(documents, monkeypatch):
    monkeypatch.setattr(quality_classifier, "CHARACTERS", 20_000)
    rows = quality_classifier.scored(documents).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_classifier_on_odd_rows(odd):
    rows = quality_classifier.scored(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)


# 8 packing


def library_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packing(documents, odd, none):
    for df in (documents, odd):
        pieces = collections.defaultdict(list)
        windows = collections.defaultdict(list)
        for r in packing.pack(df).collect():
            pieces[r["doc_id"]].append(r)
            windows[r["sequence_id"]].append(r)
        for w in windows.values():
            at = 0
            for r in sorted(w, key=lambda r: r["offset"]):
                assert r["offset"] == at and r["length"] > 0
                at += r["length"]
            assert at <= 1024
        total = sum(r["length"] for w in windows.values() for r in w)
        assert len(windows) * 1024 - total <= 1024 * df.rdd.getNumPartitions()
        docs = collections.defaultdict(list)
        for d, t in texts_of(df):
            docs[d].append(t)
        for d, texts in docs.items():
            if len(texts) == 1:
                ids = [*library_ids(texts[0]), 0]
                at = 0
                for r in sorted(pieces[d], key=lambda r: r["start"]):
                    part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
                    assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part.tobytes())
                    at += r["length"]
                assert at == len(ids)
    assert packing.pack(none).count() == 0


def test_windows_rise_where_items_stay_whole():
    random.seed(8)
    sizes = [random.randint(1, 1024) for _ in range(60)]
    parts = packing.partitioned(sizes, 1024, trim=False)
    assert all(sum(b - a for _, a, b in p) <= 1024 for p in parts) and sorted(k for p in parts for k, _, _ in p) == list(range(60))
    even = packing.differenced([8, 7, 6, 5, 4], 2)
    assert abs(sum([8, 7, 6, 5, 4][k] for k in even[0]) - 15) <= 1


def test_added_tokens_are_one_id(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|>", "  <|endoftext|>  x <|endoftext|><|endoftext|>\n", "cut <|endoftext", "plain text", "after \t<|endoftext|> <|ENDOFTEXT|>"]
    ids = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert sum(x.count(50256) for x in ids) == 6
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    packed = packing.pack(df).collect()
    assert sorted((r["doc_id"], r["doc_tokens"], r["length"], r["ids_crc32"]) for r in packed) == [(k, len(x), len(x), c) for k, (x, c) in enumerate(zip(ids, crc, strict=True))]
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    rows = wavelet.read(wavelet.write(df)).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == [(k, starts[k], len(x), c) for k, (x, c) in enumerate(zip(ids, crc, strict=True))]


# 9 embeddings


def test_embeddings_are_brute_force(spark):
    rng = np.random.default_rng(9)
    vectors, labels = [], []
    for _ in range(60):
        v = rng.normal(size=64)
        for _ in range(rng.integers(1, 7)):
            vectors.append(v + rng.normal(size=64) * rng.choice([0, 0.02, 0.1, 0.14, 0.3]))
            labels.append(int(rng.integers(0, 2)))
    rows = [(k, [float(np.float32(y)) for y in x], l) for k, (x, l) in enumerate(zip(vectors, labels, strict=True))]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 64, 0), (n + 2, [float("nan")] * 64, 0), (n + 3, [None] + [1.0] * 63, 0), (n + 4, rows[0][1], None), (None, rows[0][1], rows[0][2]), (n + 5, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("clash"))
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(df.repartition(3)).collect()}
    a = np.array([r[1] for r in rows[:n]])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    near = (a @ a.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None, :]) & ~np.eye(n, dtype=bool)
    component = np.arange(n)
    for _ in range(n):
        for i, j in zip(*np.nonzero(near), strict=True):
            component[i] = min(component[i], component[j])
    for k in range(n):
        assert (found[k]["n_links"], found[k]["component_id"], found[k]["kept"]) == (near[k].sum(), component[k], component[k] == k)
    for k in range(n, n + 6):
        assert (found[k]["n_links"], found[k]["component_id"], found[k]["kept"]) == (0, k, True)
    assert found[None]["component_id"] is None and not found[None]["kept"]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_lengths_beyond_the_sample(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SAMPLE", 1)
    rows = [(2 * n + k, [1.0] * n + [0.01 * k], 1) for n in range(2, 12) for k in range(2)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(i, 1, i - i % 2) for i, _, _ in rows]


def test_embeddings_in_cells_of_many_pieces(spark, monkeypatch):
    """Clusters whose vectors lie in adjacent cells, cells cut into pieces, equal vectors, doubles."""
    monkeypatch.setattr(embeddings, "PIECE", 5)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 24))
    vectors = np.array([centres[k % 4] + rng.normal(size=24) * (0.09 + 0.05 * (k % 3)) for k in range(160)])
    vectors[120:140] = vectors[7]
    rows = [(k, v.tolist(), 3) for k, v in enumerate(vectors)]
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    size = np.linalg.norm(vectors, axis=1)
    near = ((vectors @ vectors.T) / size[:, None] / size[None, :] >= 0.98) & ~np.eye(160, dtype=bool)
    component = np.arange(160)
    for _ in range(160):
        for i, j in zip(*np.nonzero(near), strict=True):
            component[i] = min(component[i], component[j])
    assert near.any() and len(set(component)) > 4
    assert [(found[k]["n_links"], found[k]["component_id"]) for k in range(160)] == [(near[k].sum(), component[k]) for k in range(160)]


# 10 wavelet


def test_wavelet_matrix():
    rng = np.random.default_rng(10)
    for size in (0, 1, 511, 512, 513, 3000):
        ids = rng.choice(50257, size=size) if size != 3000 else rng.integers(0, 9, size)
        m = wavelet.WaveletMatrix.load(wavelet.WaveletMatrix.build(ids.astype("<u4")).blob())
        assert m.ids().tolist() == ids.tolist()
        for at in range(0, size, 97):
            token = int(ids[at])
            assert m.access(at) == token and m.rank(token, at) == (ids[:at] == token).sum()
            k = m.rank(token, at)
            assert m.select(token, k) == at and m.select(token, m.rank(token)) == -1
        assert m.rank(70000) == 0


def test_shards_hold_the_documents(documents, odd, none):
    for df in (documents, odd):
        docs = sorted((-(2**63) if d is None else d, t or "") for d, t in texts_of(df))
        rows = sorted(wavelet.read(wavelet.write(df, shard_ids=5000)).collect(), key=lambda r: r["start"])
        at = 0
        assert [r["doc_id"] for r in rows] == [None if d == -(2**63) else d for d, _ in docs]
        for r, (d, t) in zip(rows, docs, strict=True):
            assert r["start"] == at
            if sum(x == d for x, _ in docs) == 1:
                ids = np.array([*library_ids(t), 0], "<u4")
                assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes())
            at += r["n_tokens"]
    table = wavelet.write(odd)
    assert wavelet.lookup(table, 0).agg(F.sum("occurrences")).first()[0] >= odd.count()
    assert wavelet.read(wavelet.write(none)).count() == 0
