"""Personal data, and the terms that give it away.

Fixed patterns find e-mail and IP addresses, card and phone numbers. Each found value is a protected entity, and every
word of the documents that hold it, however far away, is a candidate term. The corpus says how strongly a term reveals the
entity: the pointwise mutual information of the two over documents, as a share of the entity's own information content
(1: who sees the term knows the entity). A term reveals an entity if this share reaches ``DISCLOSURE`` and so many of the
entity's texts with the term would come by chance, for any word of the vocabulary, with a probability below ``CHANCE``.
So an entity of two texts can have terms; one of a single text has none in a corpus of any size, as each of that text's
rare words is met by chance. Revealing terms are spans of kind ``term`` wherever a text of the corpus holds them; masking
generalises base spans to their kind and removes terms. Chance counts different texts, else every rare word of a text
that was copied would count as revealing.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import over_blocks, whole, written

KINDS = ("email", "ip", "card", "phone")
STRIPPED = ".,;:!?()\"'"
DISCLOSURE = 0.8
CHANCE = 0.01
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so a long run of address characters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four kinds, in their order, then by start; the end is exclusive."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(bare := part.lstrip("0")) <= 3 and int(bare or 0) <= 255 for part in m[0].split(".")):  # a part of any length
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def term_of(word: str) -> str:
    return word.strip(STRIPPED).lower()


def outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """The words that no span overlaps, as they stand there, and the places of their terms."""
    covered, at = sorted((a, b) for _, a, b in spans), 0
    reach = 0  # end of the spans that begin before the word's end
    for m in WORD.finditer(text):
        bare = m[0].strip(STRIPPED)
        if bare:
            a = m.start() + m[0].index(bare)
            while at < len(covered) and covered[at][0] < a + len(bare):
                reach, at = max(reach, covered[at][1]), at + 1
            if reach <= a:
                yield m[0], a, a + len(bare)


def terms_of(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    """Each term of a text once."""
    words = {w for w, _, _ in outside(text, spans)} if spans else set(WORD.findall(text))
    return {term for w in words if (term := term_of(w))}


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def held(docs: DataFrame) -> DataFrame:
    """The digest of every text, with the entities and terms of those that hold an entity."""

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = []
        for text in block["text"].to_pylist():
            spans = base_spans(text)
            entities = list({f"{kind}:{text[a:b]}" for kind, a, b in spans})
            rows.append((xxhash.xxh3_64_intdigest(text.encode()) - 2**63, entities, list(terms_of(text, spans)) if spans else []))
        kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["text_hash", "entities", "terms"])

    return over_blocks(whole(docs), run, "text_hash long, entities array<string>, terms array<string>")


def counted(docs: DataFrame) -> DataFrame:
    """``n_term`` documents of each term; a task counts a block of documents before anything is shuffled."""

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for text in block["text"].to_pylist():
            for term in terms_of(text, base_spans(text)):
                counts[term] = counts.get(term, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

    return over_blocks(whole(docs), run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def evidence(both: Column, one: Column, other: Column, total: Column) -> Column:
    """Hoeffding's bound for draws without replacement: minus the logarithm of the probability that ``both`` or more of
    ``one`` texts are among ``other`` out of ``total`` by chance."""
    share, rate = both / one, other / total
    rest = F.when(both < one, (one - both) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return F.when(share > rate, both * F.log(share / rate) + rest).otherwise(0.0)


def revealing(docs: DataFrame) -> DataFrame:
    """The terms that reveal an entity, each once.

    With the best term possible an entity of n texts has evidence n log(texts / n), a pair of it as much for the texts
    that it shares: what cannot reach the bound goes before the words of its texts, or their counts, are joined.
    """
    texts, counts = written(held(docs), "pii-texts"), written(counted(docs), "pii-words")
    corpus, different = texts.agg(F.count("*"), F.count_distinct("text_hash")).first()
    needed, total = math.log(max(counts.count(), 1) / CHANCE), F.lit(float(different))
    holders = texts.where(F.size("entities") > 0)
    each = holders.select("text_hash", F.explode("entities").alias("entity")).groupBy("entity", "text_hash").agg(F.count("*").alias("copies"))
    entities = each.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("entity_texts"))
    entities = written(entities.where(F.col("entity_texts") * F.log(total / F.col("entity_texts")) >= needed), "pii-entities")
    if entities.isEmpty():
        return counts.select("term").limit(0)
    each = each.join(entities.select("entity"), "entity").groupBy("text_hash").agg(F.first("copies").alias("copies"), F.collect_list("entity").alias("entities"))
    words = holders.select("text_hash", "terms").join(each.select("text_hash"), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    pairs = words.join(each, "text_hash").select("copies", "terms", F.explode("entities").alias("entity")).select("entity", "copies", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("copies").alias("both"), F.count("*").alias("both_texts"))
    pairs = pairs.join(entities, "entity").where(F.col("both_texts") * F.log(total / F.col("entity_texts")) >= needed).join(counts, "term")
    pmi = F.log(F.col("both") * F.lit(float(corpus)) / (F.col("n_entity") * F.col("n_term")))
    information = F.log(F.lit(float(corpus)) / F.col("n_entity"))
    term_texts = F.least(F.col("n_term").cast("double"), total)  # copies are not told apart here: at most so many texts
    chance = F.greatest(evidence(F.col("both_texts"), F.col("entity_texts"), term_texts, total), evidence(F.col("both_texts"), term_texts, F.col("entity_texts"), total))
    return pairs.where((information > 0) & (pmi >= DISCLOSURE * information) & (chance >= needed)).select("term").distinct()


def known(docs: DataFrame) -> Broadcast:
    """The sorted 64-bit digests of all revealing terms: eight bytes for each is what driver and tasks hold."""
    digests = revealing(docs).select(F.xxhash64("term").alias("digest")).toArrow()["digest"].to_numpy()
    return docs.sparkSession.sparkContext.broadcast(np.sort(digests))


class Terms:
    """Finds the places of revealing terms, and remembers which words of a block are none."""

    def __init__(self, digests: np.ndarray):
        self.digests, self.plain = digests, set()

    def reveals(self, word: str) -> bool:
        digest = xxhash.xxh64_intdigest(term_of(word).encode(), seed=42)  # as Spark's xxhash64
        digest = np.int64(digest - (digest >> 63 << 64))
        at = int(np.searchsorted(self.digests, digest))
        return at < len(self.digests) and self.digests[at] == digest

    def places(self, text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
        if not len(self.digests):
            return []
        words = set(WORD.findall(text)) - self.plain
        found = {w for w in words if self.reveals(w)}
        self.plain |= words - found
        return [(a, b) for w, a, b in outside(text, spans) if w in found] if found else []


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with the text's base spans replaced by ``<kind>`` and revealing terms taken out wherever they stand.

    Overlapping spans are one, named by the first. Null texts stay null, empty ones empty; rows that share or lack an id
    are masked each by its own text; other columns and rows stay as they are. An empty table gives no rows.
    """
    shared = known(docs)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        out, terms = [], Terms(shared.value)
        for text in texts:
            if text is None:
                out.append(None)
                continue
            base = base_spans(text)
            spans = [(a, b, f"<{kind}>") for kind, a, b in base] + [(a, b, "") for a, b in terms.places(text, base)]
            parts, at = [], 0
            for a, b, name in sorted(spans):
                if a >= at:
                    parts += [text[at:a], name]
                at = max(at, b)
            out.append("".join(parts) + text[at:] if spans else text)
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", mask(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def detect(docs: DataFrame) -> DataFrame:
    """Per document the counts of each kind, the digest of the base spans and all spans.

    A null text is empty; empty texts have no spans. Texts are searched whole, digit runs of any length included. Spans
    are found in each row's own text, so a repeated row has the spans of its text again and rows that share an id do not
    mix; a null id stays null. Terms that tie at a threshold count. An empty table gives no rows. Other columns are not
    read.
    """
    shared = known(docs)

    def run(block: pa.Table) -> Iterator[pa.RecordBatch]:
        rows, terms = [], Terms(shared.value)
        for doc, text in zip(block["doc_id"].to_pylist(), block["text"].to_pylist(), strict=True):
            spans = base_spans(text)
            kinds = [kind for kind, _, _ in spans]
            more = [("term", a, b) for a, b in terms.places(text, spans)]
            rows.append((doc, *(kinds.count(kind) for kind in KINDS), hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans + more)))
        types = [*[pa.int64()] * (1 + len(KINDS)), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
    return over_blocks(whole(docs), run, ", ".join(f"{n} {'string' if n in ('base_sha256', 'spans') else 'long'}" for n in names))
