"""Audit of how sources of a language diverge in their words: smoothed term shares in fixed-point whole numbers.

* Pass 1 counts exact document frequencies: per block of texts, then summed; terms of enough documents are kept.
* Pass 2 recounts occurrences with Aho-Corasick automata of kept terms, each padded with a delimiter on both sides, over
  texts in which every run of delimiters is one. Kept terms are dealt into parts of about ``PART_BYTES`` by hash; a part is
  broadcast at a time, and texts are gone through once per part. So what is broadcast is bounded, whatever the vocabulary.
* A group's share of a term that it lacks is the same for all such terms, so the distance of two sources is that of their
  shares of nothing, times the kept terms, and corrections by the terms that either has: sums over postings, in slices of
  terms and squares of ``SOURCES`` x ``SOURCES`` sources.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import over_blocks, written

#: Documents of a language that must hold a term.
DOCUMENTS = 30
#: Fixed-point one, and what is added to every count.
ONE, ADDED = 1_000_000_000, 5
#: Ranks of part ``term``.
RANKS = 50
#: Bytes of terms that are broadcast at once, on average of parts dealt by hash.
PART_BYTES = 8 << 20
#: Text bytes of a block.
TEXT_BYTES = 8 << 20
#: Postings of a slice of terms, on average, and sources of a square's side.
SLICE, SOURCES = 200_000, 512

GROUP = ["lang", "source"]
#: ASCII letters in lower case, other ASCII characters as blanks, bytes of other characters as they are.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def rows_of(docs: DataFrame) -> DataFrame:
    """``lang``, ``source`` and ``text`` of documents, nulls as empty strings; other columns are left behind."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _terms(block: pa.Table) -> Iterator[list[bytes]]:
    """The terms of each text, in order."""
    return (text.translate(LETTERS).split() for text in block.column("text").cast(pa.binary()).to_pylist())


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``lang``, ``term`` and ``n``: in how many of the language's documents it stands."""

    def work(block: pa.Table) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for lang, terms in zip(block.column("lang").to_pylist(), _terms(block), strict=True):
            found.setdefault(lang, Counter()).update(set(terms))
        for lang, counts in found.items():
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(counts)), pa.array(counts, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "term", "n"])

    return over_blocks(docs, work, "lang string, term string, n long", limit=TEXT_BYTES).groupBy("lang", "term").agg(F.sum("n").alias("n"))


#: The automata of the part that a worker counts at present.
_BUILT: dict[str, dict[str, ahocorasick.Automaton]] = {}


def automata(part: str, terms: pa.Table) -> dict[str, ahocorasick.Automaton]:
    """An automaton per language over its padded terms, built once in a worker and kept until another part comes."""
    if part not in _BUILT:
        _BUILT.clear()
        found: dict[str, ahocorasick.Automaton] = {}
        for k, (lang, term) in enumerate(zip(terms.column("lang").to_pylist(), terms.column("term").to_pylist(), strict=True)):
            found.setdefault(lang, ahocorasick.Automaton()).add_word(f" {term} ", k)
        for automaton in found.values():
            automaton.make_automaton()
        _BUILT[part] = found
    return _BUILT[part]


def occurrences(docs: DataFrame, kept: DataFrame, parts: int) -> DataFrame:
    """``lang``, ``source``, ``term`` and ``n``: how often each kept term of a language stands in each source that has it.
    ``kept``: lang, term and part, a number below ``parts``; texts are gone through once per part."""
    spark, schema = docs.sparkSession, "lang string, source string, term string, n long"

    def counted(part: int) -> DataFrame:
        sent, name = spark.sparkContext.broadcast(kept.where(F.col("part") == part).select("lang", "term").toArrow()), uuid.uuid4().hex

        def work(block: pa.Table) -> Iterator[pa.RecordBatch]:
            built, found = automata(name, sent.value), {}
            for lang, source, terms in zip(block.column("lang").to_pylist(), block.column("source").to_pylist(), _terms(block), strict=True):
                if lang in built and terms:
                    text = f" {b' '.join(terms).decode()} "
                    found.setdefault((lang, source), Counter()).update(map(itemgetter(1), built[lang].iter(text)))
            terms = sent.value.column("term")
            for (lang, source), counts in found.items():
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(counts)), pa.repeat(source, len(counts)), terms.take(pa.array(counts, pa.int64())).combine_chunks(), pa.array(counts.values(), pa.int64())], names=["lang", "source", "term", "n"])

        return over_blocks(docs, work, schema, limit=TEXT_BYTES)

    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, map(counted, range(parts))).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(ONE * (n + ADDED) / (total + ADDED * kept)) in whole numbers; null without kept terms."""
    above = (n + ADDED).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)")
    below = (total + ADDED * kept).cast("decimal(20,0)")
    return F.when(kept > 0, 1 + F.call_function("div", above, below))


def _corrections(postings: pa.Table, zeros: pa.Table) -> pa.Table:
    """For a slice of a language's terms and a square of its sources: what each pair's distance is above that of terms that
    both lack. Sources are pairs of one block, or of the two blocks of the square."""
    names, at = np.unique(zeros.column("id").to_numpy(), return_index=True)
    nothing, block = zeros.column("nothing").to_numpy()[at], zeros.column("block").to_numpy()[at]
    size = len(names)
    source = np.searchsorted(names, postings.column("id").to_numpy())
    share_, term = postings.column("p").to_numpy(), postings.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    apart = np.abs(nothing[:, None] - nothing[None, :])
    out = np.zeros((size, size), dtype=np.int64)
    by = np.lexsort((share_, source))
    for k, own in zip(*_pieces(source[by], share_[by]), strict=True):  # terms of one against nothing in the others
        before = np.r_[0, np.cumsum(own)]
        below = np.searchsorted(own, nothing, side="right")
        distance = nothing * below - before[below] + (before[-1] - before[below]) - nothing * (len(own) - below)
        out[k] += distance - len(own) * apart[k]
    out += out.T.copy()
    by = np.argsort(term, kind="stable")
    term, source, share_ = term[by], source[by], share_[by]
    step = 1
    while step < len(term):  # terms of both: neighbours of a posting list, one step further apart each time
        here = np.flatnonzero(term[step:] == term[:-step])
        if not len(here):
            break
        a, b = source[here], source[here + step]
        p, q = share_[here], share_[here + step]
        np.add.at(out, (np.minimum(a, b), np.maximum(a, b)), np.abs(p - q) - np.abs(p - nothing[b]) - np.abs(nothing[a] - q) + apart[a, b])
        step += 1
    one, other = np.triu_indices(size, 1)
    if block.min() != block.max():
        crossing = block[one] != block[other]
        one, other = one[crossing], other[crossing]
    return pa.table({"lang": pa.repeat(zeros.column("lang")[0], len(one)), "one": names[one], "other": names[other], "more": out[one, other]})


def _pieces(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Sorted keys, each once, with its values."""
    if not len(keys):
        return [], []
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first].tolist(), np.split(values, first[1:])


def pair_distances(groups: DataFrame, postings: DataFrame, slices: DataFrame) -> DataFrame:
    """``lang``, ``one``, ``other`` (numbers of sources, the smaller first) and ``more``: the sum over terms that either
    source has of what they add to the distance. ``groups``: lang, id, nothing (share of an absent term); ``postings``:
    lang, id, term, p; ``slices``: lang, slices. A posting goes to as many squares as its language has blocks of sources."""
    key = ["lang", "row", "column", "slice"]
    blocks = groups.groupBy("lang").agg(F.max(F.floor(F.col("id") / SOURCES)).alias("last"))
    block = F.floor(F.col("id") / SOURCES)
    squares = F.explode(F.transform(F.sequence(F.lit(0), "last"), lambda b: F.struct(F.least(b, "block").alias("row"), F.greatest(b, "block").alias("column"))))

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides come from one table
        return rows.withColumn("block", block).join(blocks, "lang").join(slices, "lang").withColumn("square", squares).select("*", "square.row", "square.column")

    dealt_postings = dealt(postings).withColumn("slice", F.pmod(F.xxhash64("term"), "slices")).select(*key, "id", "term", "p")
    dealt_zeros = dealt(groups).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).select(*key, "id", "block", "nothing")
    both = dealt_postings.groupBy(*key).cogroup(dealt_zeros.groupBy(*key)).applyInArrow(_corrections, "lang string, one long, other long, more long")
    return both.groupBy("lang", "one", "other").agg(F.sum("more").alias("more"))


def audit(docs: DataFrame, documents: int = DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair``: for each source of a language every other one with the sum of absolute differences of their shares over
    the kept terms, the most distant first. Part ``term``: the kept terms that the source has more of than its language,
    with the difference of shares, the first ``ranks``. Ties by item. Null text, language and source are empty strings, each
    a value of its own; a source without terms has shares too; a language without kept terms has distances of 0; repeated
    rows count as often as they are there; other columns are left behind. The result of part ``pair`` has a row for each
    ordered pair of a language's sources, and so it grows with their square; terms never make pairs of rows."""
    rows = rows_of(docs)
    terms = written(document_frequencies(rows).where(F.col("n") >= documents).select("lang", "term"), "divergence-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 2)).first()[0] or 0
    parts = -(-size // PART_BYTES)
    counts = written(occurrences(rows, terms.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(max(1, parts)))), parts), "divergence-counts")

    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = rows.select(*GROUP).distinct().join(kept, "lang", "left").join(totals, GROUP, "left").na.fill(0, ["kept", "total", "own"])
    groups = groups.withColumn("id", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1).withColumn("nothing", F.coalesce(share(F.lit(0), F.col("total"), F.col("kept")), F.lit(0)))
    groups = written(groups, "divergence-groups")
    slices = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.sum("own") / SLICE)).cast("long").alias("slices"))
    postings = counts.join(groups, GROUP).select(*GROUP, "id", "term", "n", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))

    one, other = (groups.select("lang", F.col("source").alias(a), F.col("id").alias(b), F.col("nothing").alias(c), "kept") for a, b, c in (("source_a", "one", "z_a"), ("source_b", "other", "z_b")))
    pairs = one.join(other.drop("kept"), "lang").where("one < other").join(pair_distances(groups.select("lang", "id", "nothing"), postings.select("lang", "id", "term", "p"), slices), ["lang", "one", "other"], "left")
    pairs = pairs.withColumn("value", F.col("kept") * F.abs(F.col("z_a") - F.col("z_b")) + F.coalesce("more", F.lit(0)))
    sides = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    pairs = pairs.select("lang", sides.alias("side"), "value").select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")

    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    sums = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    usual = whole.join(sums, "lang").select("lang", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("q"))
    more = postings.join(usual, ["lang", "term"]).where("p > q").select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(more.withColumn("rank", rank).where(F.col("rank") <= ranks))


#: The audit of ``documents`` as DuckDB SQL.
SQL = r"""with d as (select coalesce(lang, '') lang, coalesce(source, '') source, row_number() over () k,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') terms from documents),
w as (select lang, source, k, unnest(terms) term from d),
v as (select lang, term from w group by 1, 2 having count(distinct k) >= 30),
nv as (select lang, cast(count(*) as hugeint) kept from v group by 1),
c as (select w.lang, source, w.term, cast(count(*) as hugeint) n from w join v on v.lang = w.lang and v.term = w.term group by 1, 2, 3),
g as (select d.lang, d.source, coalesce(max(nv.kept), 0) kept, coalesce(max(t.total), 0) total from (select distinct lang, source from d) d left join nv on nv.lang = d.lang
  left join (select lang, source, sum(n) total from c group by 1, 2) t on t.lang = d.lang and t.source = d.source group by 1, 2),
p as (select g.lang, g.source, v.term, coalesce(c.n, 0) n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.kept) p from g join v on v.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = v.term),
l as (select lang, term, 1 + (1000000000 * (sum(n) + 5)) // (any_value(total) + 5 * any_value(kept)) q from (select p.lang, p.term, p.n, kept, sum(n) over (partition by p.lang) total from p join nv on nv.lang = p.lang) group by 1, 2),
pairs as (select a.lang, a.source, 'pair' part, b.source item, coalesce(f, 0) value from g a join g b on b.lang = a.lang and b.source <> a.source
  left join (select a.lang, a.source s, b.source t, sum(abs(a.p - b.p)) f from p a join p b on b.lang = a.lang and b.term = a.term and b.source <> a.source group by 1, 2, 3) f on f.lang = a.lang and f.s = a.source and f.t = b.source),
more as (select p.lang, p.source, 'term' part, p.term item, p.p - q value from p join l on l.lang = p.lang and l.term = p.term where n > 0 and p.p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) rank from (select * from pairs union all select * from more)) where part = 'pair' or rank <= 50"""
