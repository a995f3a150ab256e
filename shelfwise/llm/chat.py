"""Chat formatting: records of any layout become turns, and turns a formatted text with its loss mask, reversibly.

* A record is JSON. The hash of its nested field paths (``messages[].role``) is its fingerprint, by which a declarative
  ``Layout`` is selected: where its turns lie, which fields say role and text, or which fields are turns themselves.
* A ``Template`` gives each role a mark before and a mark behind its text. A mark's string inside a text is broken by a
  backslash behind its first character (one that is broken already gets one more), so marks in the output are the
  template's alone and the texts can be read back as they were.
* Output is a row per turn, so that a conversation of any length is formatted without being held: its text is its rows'
  strings one behind the other.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, step int, layout string, role string, text string"
FORMATTED = "conv_id long, turn long, step int, layout string, formatted string, loss_start int, loss_length int"
SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
UNKNOWN = "unknown"


# Layouts --------------------------------------------------------------------------------------------------------------


def paths(value: object, at: str = "") -> set[str]:
    """The field paths of a JSON value down to its scalars; an empty object or array ends its path too."""
    if isinstance(value, dict) and value:
        return set().union(*(paths(v, f"{at}.{json.dumps(k, ensure_ascii=False) if not k.isidentifier() else k}") for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths(v, f"{at}[]") for v in value))
    return {at + ("{}" if isinstance(value, dict) else "[]" if isinstance(value, list) else "")}


def fingerprint(found: Iterable[str]) -> str:
    """64 bits of SHA-256 over sorted field paths."""
    return hashlib.sha256("\n".join(sorted(found)).encode(errors="surrogatepass")).hexdigest()[:16]


@dataclass(frozen=True)
class Layout:
    """How the records of some field paths are read.

    ``turns``: pairs of a role and the field of its text (instruction and prompt layouts), or ``messages``: the field of an
    array of objects (empty: the record is one turn itself) with ``role`` and ``text`` fields. ``input``: a field that
    follows the first turn's text after a blank line, unless it is empty. ``roles``: canonical names of roles.
    ``required`` and ``optional`` paths: every choice of the optional ones is a fingerprint of its own."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, str], ...] = ()
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    input: str | None = None
    roles: Mapping[str, str] = field(default_factory=dict)

    def fingerprints(self) -> Iterator[str]:
        if len(self.optional) > 10:
            raise ValueError(f"layout {self.name} has more than 10 optional paths")
        for k in range(len(self.optional) + 1):
            for chosen in combinations(self.optional, k):
                yield fingerprint((*self.required, *chosen))

    def read(self, record: dict) -> list[tuple[str, str]]:
        """The record's turns as role and text. Fields that are null or missing are empty texts, but optional fields of an
        instruction layout that are null, missing or empty make no turn."""
        if self.messages is None:
            out = []
            for role, source in self.turns:
                text = _text(record.get(source))
                if self.input and role == "user" and _text(record.get(self.input)):
                    text = f"{text}\n\n{_text(record[self.input])}"
                if text or f".{source}" in self.required:
                    out.append((role, text))
            return out
        rows = (record.get(self.messages) or []) if self.messages else [record]
        return [(self.roles.get(role := _text(row.get(self.role)), role), _text(row.get(self.text))) for row in rows]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


SHARED_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
LAYOUTS = (
    Layout("turn rows", (".role", ".text"), messages="", text="text"),
    Layout("messages", (".messages[].role", ".messages[].content"), (".id", ".source"), messages="messages"),
    Layout("no messages", (".messages[]",), (".id", ".source"), messages="messages"),
    Layout("conversations", (".conversations[].from", ".conversations[].value"), (".id", ".system"), turns=(), messages="conversations", role="from", text="value", roles=SHARED_NAMES),
    Layout("instruction", (".instruction", ".output"), (".input", ".system", ".id"), turns=(("system", "system"), ("user", "instruction"), ("assistant", "output")), input="input"),
    Layout("prompt", (".prompt", ".completion"), (".system", ".id"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("question", (".question", ".answer"), (".id",), turns=(("user", "question"), ("assistant", "answer"))),
)


def selection(layouts: Sequence[Layout]) -> dict[str, Layout]:
    """Layout by fingerprint; an error if two layouts claim one."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for mark in layout.fingerprints():
            if mark in found:
                raise ValueError(f"layouts {found[mark].name} and {layout.name} have a fingerprint in common")
            found[mark] = layout
    return found


def turns(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The turns of ``records``: conv_id, turn (place of the record in its conversation), record (JSON).

    One row per turn, numbered inside its record by ``step``. A record whose field paths no layout knows, or that is no
    JSON object, is one turn of role ``unknown`` whose text is the record as it came; a null record is none. Other columns
    are left behind."""
    known = selection(layouts)

    def read(raw: str, seen: dict[tuple, str]) -> tuple[str, list[tuple[str, str]]]:
        try:
            record = json.loads(raw)
        except ValueError:
            return UNKNOWN, [(UNKNOWN, raw)]
        if not isinstance(record, dict):
            return UNKNOWN, [(UNKNOWN, raw)]
        found = frozenset(paths(record))
        if found not in seen:  # as many as there are sets of paths in the batch
            seen[found] = fingerprint(found)
        layout = known.get(seen[found])
        return (UNKNOWN, [(UNKNOWN, raw)]) if layout is None else (layout.name, layout.read(record))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seen = [], {}
            for conv, turn, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if raw is not None:
                    name, found = read(raw, seen)
                    rows += [(conv, turn, step, name, role, text) for step, (role, text) in enumerate(found)]
            yield _batch(rows, [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()], TURNS)

    return records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("record")).mapInArrow(work, TURNS)


def turn_records(rows: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as records for ``turns``, nulls kept as such."""
    return rows.select("conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))


def _batch(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in schema.split(", ")])


# Templates ------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Template:
    """Marks before and behind the text of each role. Any other role is named between ``named`` marks, with ``close``
    behind its text. Control strings: every mark without the blanks and line ends around it."""

    roles: Mapping[str, tuple[str, str]]
    named: tuple[str, str]
    close: str
    learned: str = "assistant"

    def controls(self) -> list[str]:
        marks = [m.strip() for pair in self.roles.values() for m in pair] + [m.strip() for m in (*self.named, self.close)]
        found = sorted({m for m in marks if m}, key=lambda m: (-len(m), m))
        if any(len(m) < 2 or "\\" in m for m in found):
            raise ValueError("a control string has two characters at least and no backslash")
        if any(a != b and a[-k:] == b[:k] for a in found for b in found for k in range(1, min(len(a), len(b)))):
            raise ValueError("control strings overlap")
        return found


LLAMA = Template({"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>")}, ("<<ROLE>>", "<</ROLE>>"), " </s>")


class Formatter:
    """A template's formatting and reading of single turns."""

    def __init__(self, template: Template):
        self.template, controls = template, template.controls()
        broken = lambda some: "|".join(f"{re.escape(c[0])}{some}{re.escape(c[1:])}" for c in controls)
        self.plain, self.escaped = re.compile(broken(r"\\*")), re.compile(broken(r"\\+"))

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0] + m[0][2:], text)

    def format(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn's string, and where in it the text under the loss mask begins and how long it is."""
        body = self.escape(text)
        if role in self.template.roles:
            before, behind = self.template.roles[role]
        else:
            before, behind = f"{self.template.named[0]}{self.escape(role)}{self.template.named[1]}", self.template.close
        return f"{before}{body}{behind}", len(before), len(body) if role == self.template.learned else 0

    def read(self, formatted: str) -> tuple[str, str]:
        """Role and text of a turn's string."""
        opened, named = self.template.named
        if formatted.startswith(opened):
            end = formatted.index(named, len(opened))
            return self.unescape(formatted[len(opened) : end]), self.unescape(formatted[end + len(named) : len(formatted) - len(self.template.close)])
        for role, (before, behind) in sorted(self.template.roles.items(), key=lambda item: -len(item[1][0])):
            if formatted.startswith(before) and formatted.endswith(behind):
                return role, self.unescape(formatted[len(before) : len(formatted) - len(behind)])
        raise ValueError(f"no turn of the template: {formatted[:40]!r}")


@lru_cache(maxsize=8)
def _formatter(marks: tuple) -> Formatter:
    roles, named, close, learned = marks
    return Formatter(Template(dict(roles), named, close, learned))


def _maker(template: Template) -> Callable[[], Formatter]:
    marks = (tuple(template.roles.items()), template.named, template.close, template.learned)
    return lambda: _formatter(marks)


def formatted(turns_: DataFrame, template: Template = LLAMA) -> DataFrame:
    """Each turn's string with the place and length of the text under the loss mask in it (length 0: none), in code
    points. A null role or text is empty. Nothing is shuffled."""
    template.controls()  # an error of the template is the caller's
    make = _maker(template)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(conv, turn, step, layout, *make().format(role or "", text or "")) for conv, turn, step, layout, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield _batch(rows, [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()], FORMATTED)

    return turns_.select(*[c.split()[0] for c in TURNS.split(", ")]).mapInArrow(work, FORMATTED)


def read_back(texts: DataFrame, template: Template = LLAMA) -> DataFrame:
    """Per conversation the digests of what its formatted turns say, read back in order of ``turn``, ``step`` and, where
    these are tied, of the string; null turns come first, turns without conv_id are one conversation.

    A SHA-256 is taken over a conversation's turns one behind the other, so each lies in one task; they come sorted by
    Spark, which spills, and only the hash is held, so a conversation may be of any length."""
    make = _maker(template)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, began = None, False
        said = learned = None
        counts = [0, 0, 0]
        for batch in batches:
            rows = []
            for conv, string, start, length in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length")), strict=True):
                if not began or conv != now:
                    if began:
                        rows.append((now, counts[0], said.hexdigest(), counts[1], learned.hexdigest(), counts[2]))
                    now, began, said, learned, counts = conv, True, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                role, text = make().read(string)
                masked = make().unescape(string[start : start + length])
                said.update(f"{role}\n{text}\n".encode())
                learned.update(masked.encode())
                counts = [counts[0] + 1, counts[1] + len(masked), counts[2] + len(string)]
            yield _batch(rows, types, SUMMARY)
        if began:
            yield _batch([(now, counts[0], said.hexdigest(), counts[1], learned.hexdigest(), counts[2])], types, SUMMARY)

    columns = ["conv_id", "turn", "step", "formatted", "loss_start", "loss_length"]
    return texts.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "step", "formatted").mapInArrow(work, SUMMARY)


def with_marks(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The contract's conversation -7, whose texts are control strings, with all others."""
    said = "</s>[INST] ok [/INST]"
    return rows.select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
