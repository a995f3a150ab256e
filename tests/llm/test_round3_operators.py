"""Periodic runs, chat formatting and divergence audit against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import chat, divergence, periodic

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs --------------------------------------------------------------------------------------------------------


def plain_runs(words, least_words, least_power):
    out = []
    for q in range(1, len(words) // least_power + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least_words, least_power * q) and not any(words[i : i + length - d] == words[i + d : i + length] for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_plain_search(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(12):
        words, letters = [], rnd.choice([1, 2, 3, 9, 60])
        while len(words) < rnd.randint(0, 160):
            unit = [b"w%d" % rnd.randrange(letters) for _ in range(rnd.randint(1, 14))]
            words += unit * rnd.choice([1, 1, 2, 3, 4, 9])
            if rnd.random() < 0.3:
                at = rnd.randrange(len(words))
                words += words[at : at + rnd.randint(1, 50)]
        texts.append(words)
    for least in ((24, 3), (6, 2), (4, 2), (12, 4), (10, 3)):
        assert periodic.searched(texts, *least) == [plain_runs(w, *least) for w in texts]


def test_runs_of_strings_of_stretches(monkeypatch):
    monkeypatch.setattr(periodic, "STRUNG", 64)
    texts = [[b"a", b"b", b"c"] * 20, [], [b"x"] * 30, [b"%d" % k for k in range(100)], [b"a", b"b", b"c"] * 9 + [b"!"] + [b"c", b"a", b"b"] * 9]
    assert periodic.searched(texts, 24, 3) == [plain_runs(w, 24, 3) for w in texts]


def test_squares_cover_and_walks_complete_the_vocabulary():
    """All primitive squares of Fibonacci words, whose squares overlap in many ways."""
    a, b = [0], [0, 1]
    while len(b) < 120:
        a, b = b, b + a
    parts = [[b"%d" % c for c in b]]
    assert periodic.found(parts, 2, 2) == [plain_runs(parts[0], 2, 2)]


def contract_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_periodic_query_on_whole_table(spark, documents):
    from shelfwise.llm.queries import op11_periodic

    found = {r["doc_id"]: tuple(r) for r in op11_periodic(spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    short = [r for r in rows if len(r["text"] or "") < 9000]  # plain search takes quadratic time
    assert len(found) == len(rows) and len(short) > 150
    assert [found[r["doc_id"]] for r in short] == [contract_row(r["doc_id"], r["text"]) for r in short]
    assert any(r[1] for r in found.values())


def test_periodic_on_odd_rows(spark, odd, none):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    found = sorted((tuple(r) for r in periodic.periodic(odd, prepare=periodic.planted).collect()), key=key)
    assert found == sorted((contract_row(r["doc_id"], r["text"]) for r in odd.collect()), key=key)
    assert periodic.periodic(none).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic(odd, least_power=1)


# Chat formatting ------------------------------------------------------------------------------------------------------

PIECES = [*chat.LLAMA.controls(), "<", "[", "\\", "s>", "INST]", "/", " ", "\n", "a", "é", ">", "]", "<\\/s>", "[\\INST]", "🎉"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=10).map("".join), st.sampled_from(["user", "assistant", "system", "", "tool", "<<ROLE>>", "</s>"]))
def test_formatting_is_read_back(text, role):
    made = chat.Formatter(chat.LLAMA)
    string, start, length = made.format(role, text)
    assert made.read(string) == (role, text)
    assert not any(c in made.escape(text) for c in chat.LLAMA.controls())
    assert made.unescape(string[start : start + length]) == (text if role == "assistant" else "")


def test_marks_that_overlap_are_an_error():
    with pytest.raises(ValueError):
        chat.Template({"user": ("<ab>", "b><a")}, ("{{", "}}"), "<end>").controls()
    with pytest.raises(ValueError):
        chat.Template({"user": ("\\x", "y!")}, ("{{", "}}"), "<end>").controls()


LAYOUTS = [
    ({"messages": [{"role": "system", "content": "S"}, {"role": "user", "content": None}]}, [("messages", "system", "S"), ("messages", "user", "")]),
    ({"source": "x", "messages": []}, []),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]}, [("conversations", "user", "q"), ("conversations", "assistant", "a"), ("conversations", "tool", "t")]),
    ({"instruction": "do", "input": "it", "output": "done"}, [("instruction", "user", "do\n\nit"), ("instruction", "assistant", "done")]),
    ({"instruction": "do", "output": "", "system": "S"}, [("instruction", "system", "S"), ("instruction", "user", "do"), ("instruction", "assistant", "")]),
    ({"prompt": "p", "completion": "c", "id": 7}, [("prompt", "user", "p"), ("prompt", "assistant", "c")]),
    ({"question": {"a": 1}, "answer": "x"}, None),
    ({"question": "q", "answer": 5}, [("question", "user", "q"), ("question", "assistant", "5")]),
    ({"role": "user", "text": "t"}, [("turn rows", "user", "t")]),
    ({"new": 1}, None),
    ([1], None),
]


def test_layouts_by_fingerprint(spark):
    rows = [(k, 0, json.dumps(record), "clash") for k, (record, _) in enumerate(LAYOUTS)] + [(99, 0, None, ""), (100, 0, "{no json", ""), (None, None, "", "")]
    records = spark.createDataFrame(rows, "conv_id long, turn long, record string, role string")
    found = defaultdict(list)
    for r in chat.turns(records).orderBy("conv_id", "step").collect():
        found[r["conv_id"]].append((r["layout"], r["role"], r["text"]))
    for k, (record, expected) in enumerate(LAYOUTS):
        assert found[k] == ([("unknown", "unknown", json.dumps(record))] if expected is None else expected)
    assert 99 not in found and found[100] == [("unknown", "unknown", "{no json")] and found[None] == [("unknown", "unknown", "")]


def test_layouts_with_one_fingerprint_are_an_error():
    with pytest.raises(ValueError):
        chat.selection([chat.Layout("a", (".x",), (".y",)), chat.Layout("b", (".x", ".y"))])


def plain_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn), role or "", text or ""))
    out = {}
    for conv, said in by.items():
        made = chat.Formatter(chat.LLAMA)
        said.sort(key=lambda r: (*r[0][:1], r[0][1] or 0, made.format(*r[1:])[0]))
        learned = "".join(text for _, role, text in said if role == "assistant")
        out[conv] = (len(said), sha("".join(f"{role}\n{text}\n" for _, role, text in said)), len(learned), sha(learned), sum(len(made.format(*r[1:])[0]) for r in said))
    return out


def test_chat_query_on_whole_table(spark):
    from shelfwise.llm.queries import op12_chat

    mark = "</s>[INST] ok [/INST]"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()] + [(-7, 0, "user", mark), (-7, 1, "assistant", mark)]
    assert {r["conv_id"]: tuple(r)[1:] for r in op12_chat(spark, SF).collect()} == plain_chat(rows)


def test_chat_on_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", "a"), (1, None, None, "first"), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "</s>"), (None, 0, "assistant", "x" * 50_000), (2, 5, "tool", ""), (3, None, None, None), (4, 0, "assistant", "\\[INST]   🎉\x00")]
    schema = "conv_id long, turn long, role string, text string, step string, formatted int, layout double"
    df = spark.createDataFrame([(*r, "clash", 1, None) for r in rows], schema)
    read = lambda d: chat.read_back(chat.formatted(chat.turns(chat.turn_records(d))))
    assert {r["conv_id"]: tuple(r)[1:] for r in read(df).collect()} == plain_chat(rows)
    assert read(df.limit(0)).count() == 0


# Divergence audit -----------------------------------------------------------------------------------------------------


def plain_audit(rows, documents, ranks):
    """From (text, lang, source) rows, by dense sums over all kept terms."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        held[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= documents]
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in kept) + 5 * len(kept)) for t in kept}
        usual = share(sum((counts[lang, s] for s in sources), Counter()))
        of = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = sorted(((-sum(abs(of[s][t] - of[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            terms = sorted((usual[t] - of[s][t], t.encode()) for t in kept if counts[lang, s][t] and of[s][t] > usual[t])[:ranks]
            out += [(lang, s, part, item.decode(), -value, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize(("square", "slice_", "part"), [(512, 200_000, 8 << 20), (2, 7, 60), (3, 1000, 10)])
def test_audit_against_dense_sums(spark, monkeypatch, square, slice_, part):
    monkeypatch.setattr(divergence, "SOURCES", square)
    monkeypatch.setattr(divergence, "SLICE", slice_)
    monkeypatch.setattr(divergence, "PART_BYTES", part)
    rnd = random.Random(3)
    words = ["the", "Été", "straße", "日本", "A", "zz", "été", "cat-dog", "x1y", "🎉", "ÄÖ", "kilo"]
    rows = [(" ".join(rnd.choice(words[rnd.randrange(6) :]) for _ in range(rnd.randrange(12))), lang, f"s{rnd.randrange(size)}") for lang, size in (("de", 7), ("en", 2), (None, 1), ("x", 3)) for _ in range(40)]
    rows += [(None, "de", "empty"), ("", "fr", None), ("the", "fr", "a"), (None, None, None), ("the the", "de", "s1"), ("the the", "de", "s1")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 id", "'x' part", "2.0 value", "cast(null as string) term")
    got = sorted(tuple(r) for r in divergence.audit(df.repartition(3), 5, 4).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain_audit(rows, 5, 4) and any(r[2] == "term" for r in got)


def test_audit_of_nothing_and_of_rare_terms(spark, none, odd):
    assert divergence.audit(none).count() == 0
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    got = sorted(tuple(r) for r in divergence.audit(odd).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain_audit(rows, 30, 50) and all(r[4] == 0 for r in got)


def test_audit_query_against_sql(spark):
    import duckdb

    from shelfwise.llm.queries import op13_divergence

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in op13_divergence(spark, folder).select(*columns).collect()) == sorted(con.execute(divergence.SQL).fetchall())
