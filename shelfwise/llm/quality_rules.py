"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (-1) or abstains (0). The votes of all documents are counted by pattern, of which there
are at most ``3 ** len(RULES)`` whatever the corpus holds. Expectation-maximisation over that table estimates how many
documents are good, how many are bad in each of a few ways, and how often each rule says good of each of these, from
the rules' agreement alone. A document's posterior probability of being good then replaces a filter that all rules must
pass.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, written

SPACE = "[\\x20\\x09-\\x0D]+"
#: Ways of being bad; a rule names the one that it is after.
WAYS = ["marks", "repetition", "form"]
#: Name, way, condition for a bad vote, condition for a good vote, over the columns of ``measured``; the first counts.
RULES = [
    ("length", "form", "n_words < 20", "n_words >= 80"),
    ("sentences", "form", "n_stops * 60 < n_words", "n_stops * 30 >= n_words and n_stops * 3 <= n_words"),
    ("symbols", "marks", "n_symbols * 10 > n_words", "n_symbols * 50 <= n_words"),
    ("plain", "marks", "n_plain * 10 < 7 * n_words", "n_plain * 10 >= 9 * n_words"),
    ("word_length", "marks", "word_chars < 2 * n_words or word_chars > 12 * n_words", "word_chars between 3 * n_words and 9 * n_words"),
    ("lines", "repetition", "n_dup_lines * 5 > n_lines", "n_dup_lines = 0"),
    ("repeats", "repetition", "n_repeat_words * 10 > 3 * n_words", "n_repeat_words * 12 <= n_words"),
    ("variety", "repetition", "n_distinct * 5 < n_words", "n_distinct * 3 >= n_words"),
]
ROUNDS = 12
#: Weak supervision takes every rule to be better than chance: the least chance to say good of a good document, the
#: greatest to say so of one that is bad in the rule's way, and the range for other ways.
OF_GOOD, OF_BAD, OF_OTHER = 0.9, 0.6, (0.3, 0.98)
KEPT_FROM = 0.5
PREFIX = "__quality_"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_stops", "n_plain"]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three that the text holds twice or more."""

    def marked(s: Column) -> Column:
        """Starts of the repeated windows, in order, of (window, start) sorted by window."""
        return F.array_sort(F.array_compact(F.transform(s, lambda x, k: F.when(F.coalesce(F.when(k > 0, F.get(s, k - 1)["g"] == x["g"]), F.lit(False)) | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False)), x["i"]))))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    grams = F.transform(words, lambda w, k: F.concat(w, F.lit(" "), F.get(words, k + 1), F.lit(" "), F.get(words, k + 2)))
    grams = F.slice(grams, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    slow = lambda g: let(let(F.array_sort(F.transform(g, lambda x, k: F.struct(x.alias("g"), k.alias("i")))), marked), covered)
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(slow(g)))


def once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with these columns, worked out once a row: conditions on them aren't moved below and repeated."""
    return rows.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the measures behind its columns; a null text has no words."""
    body = F.coalesce(F.col(text), F.lit(""))
    w, lines = f"{prefix or PREFIX}words", f"{prefix or PREFIX}all_lines"
    parts = {w: F.array_remove(F.split(body, SPACE), ""), lines: F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))}
    split = once(docs, parts)
    words, kept_lines = F.col(w), F.col(lines)
    measures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]", "")),
        "n_lines": F.size(kept_lines),
        "n_dup_lines": F.size(kept_lines) - F.size(F.array_distinct(kept_lines)),
        "n_repeat_words": repeat_words(words),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_stops": F.length(body) - F.length(F.regexp_replace(body, "[.!?]", "")),
        "n_plain": F.size(F.filter(words, lambda x: x.rlike("^\\p{L}+[.,;:!?]?$"))),
    }
    return once(split, {f"{prefix}{name}": value.cast("long") for name, value in measures.items()}).drop(w, lines)


def voted(rows: DataFrame, prefix: str = "") -> DataFrame:
    """``rows`` with the array ``votes``, a vote of each rule."""
    named = lambda sql: reduce(lambda s, m: s.replace(m, f"`{prefix}{m}`"), MEASURES, sql) if prefix else sql
    votes = [F.expr(f"case when {named(bad)} then -1 when {named(good)} then 1 else 0 end") for _, _, bad, good in RULES]
    return rows.withColumn(f"{prefix}votes", F.array(*votes))


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def start() -> tuple[list[float], list[list[float]]]:
    """Shares of good documents and of each way of being bad, and for these each rule's chance to say good."""
    says = [[0.95] * len(RULES)] + [[0.3 if way == own else 0.85 for _, own, _, _ in RULES] for way in WAYS]
    return [0.85] + [0.15 / len(WAYS)] * len(WAYS), says


def posteriors(shares: list[float], says: list[list[float]], prefix: str = "") -> Column:
    """Array of the probabilities of good and of each way of being bad."""
    table = lambda f: F.array(*[F.array(*[F.lit(f(x)) for x in chances]) for chances in says])
    good, bad = table(math.log), table(lambda x: math.log(1 - x))

    def log(share: Column, c: Column) -> Column:
        each = F.transform(F.col(f"{prefix}votes"), lambda v, k: F.when(v > 0, F.get(F.get(good, c), k)).when(v < 0, F.get(F.get(bad, c), k)).otherwise(0.0))
        return F.aggregate(each, share, lambda a, x: a + x)

    logs = F.transform(F.array(*[F.lit(math.log(x)) for x in shares]), log)
    odds = lambda x, all_logs: 1 / F.aggregate(all_logs, F.lit(0.0), lambda a, y: a + F.exp(F.least(y - x, F.lit(500.0))))
    return let(logs, lambda all_logs: F.transform(all_logs, lambda x: odds(x, all_logs)))


def estimated(votes: DataFrame, rounds: int = ROUNDS, prefix: str = "") -> tuple[list[float], list[list[float]]]:
    """Shares and chances as of ``start``, by expectation-maximisation over the patterns of votes.

    Of no documents, the start is returned.
    """
    patterns = checkpointed(votes.groupBy(F.col(f"{prefix}votes").alias("votes")).agg(F.count("*").alias("n")).coalesce(1))
    shares, says = start()
    for _ in range(rounds):
        by_class = patterns.select("n", "votes", F.posexplode(posteriors(shares, says)).alias("c", "p"))
        by_rule = by_class.select("c", (F.col("n") * F.col("p")).alias("w"), F.posexplode("votes").alias("k", "v"))
        sums = by_rule.groupBy("c", "k").agg(F.sum("w").alias("all"), F.sum(F.when(F.col("v") != 0, F.col("w")).otherwise(0.0)).alias("cast"), F.sum(F.when(F.col("v") > 0, F.col("w")).otherwise(0.0)).alias("good"))
        r = {(x["c"], x["k"]): x for x in sums.collect()}
        if not r:
            break
        total = sum(r[c, 0]["all"] for c in range(len(shares)))
        shares = [(r[c, 0]["all"] + 1) / (total + len(shares)) for c in range(len(shares))]
        for c in range(len(shares)):
            for k, (_, way, _, _) in enumerate(RULES):
                low, high = (OF_GOOD, 0.9999) if not c else (0.0001, OF_BAD) if way == WAYS[c - 1] else OF_OTHER
                says[c][k] = min(high, max(low, (r[c, k]["good"] + 1) / (r[c, k]["cast"] + 2)))
    return shares, says


def quality(docs: DataFrame) -> DataFrame:
    """One row per document with its measures, ``base_failed``, the ``posterior`` and ``kept``.

    A null or empty text has no words and fails; a text of any length is measured whole. Repeated rows are each measured,
    also where their id is null; a posterior of exactly ``KEPT_FROM`` is kept. An empty table gives no rows. Other columns
    than ``doc_id`` and ``text`` are not read, so they may have any names.
    """
    rows = written(measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"), "quality")
    votes = voted(rows)
    shares, says = estimated(votes)
    scored = votes.withColumn("posterior", posteriors(shares, says)[0]).withColumn("base_failed", base_failed())
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("posterior") >= KEPT_FROM)).alias("kept"), "posterior")


def good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Rows that ``quality`` keeps: a null or empty text goes, a text of any length is measured whole, repeated rows stay or
    go together, also where ids are null, and a posterior of exactly ``KEPT_FROM`` is kept. An empty table gives no rows.
    Measures bear names that no column of ``docs`` begins with, so its columns may have any names.
    """
    taken = [c.lower() for c in docs.columns]
    prefix = next(p for p in (f"{PREFIX}{k}_" for k in range(len(taken) + 1)) if not any(c.startswith(p) for c in taken))
    votes = voted(measured(docs, prefix=prefix), prefix)
    shares, says = estimated(votes, prefix=prefix)
    return votes.where(~base_failed(prefix) & (posteriors(shares, says, prefix)[0] >= KEPT_FROM)).select(*[F.col(f"`{c}`") for c in docs.columns])
