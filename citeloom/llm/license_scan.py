"""Licence scans: identifier tags, notice phrases, and the and/or/with expressions they form.

Words are runs of letters, digits and non-ASCII characters, A–Z lower-cased. One Aho-Corasick
automaton over the words of a text, joined by single blanks, finds at once

* the base phrases, with their labels,
* notice phrases of further licences, and of exceptions to them,
* identifier tags such as ``SPDX-License-Identifier``, whose expression is the rest of the line.

Expressions come from two places. What follows a tag in its line is cut into identifiers, ``AND``, ``OR``, ``WITH``
and brackets. In running text, notice phrases are operands (of phrases that overlap, the first and longest), and
two of them belong to one expression where at most twelve words lie between them, exactly one of them
``and``, ``or`` or ``with``, the others words that go with a licence's name ("or any later version" is such words). A shunting-yard parser
turns either into postfix order, ``WITH`` before ``AND`` before ``OR``, and evaluates it with one stack: the
result is how freely the text may be used, from 0 to 1. A choice counts as its freer side, a conjunction as its
stricter side, an exception moves a licence half-way towards permissive ones. A document's score is the least of its
expressions; 0.5 stands for no statement.

Defined cases: null counts as the empty text; an expression that can't be parsed (brackets left open, an operator
without an operand, nothing at all) has the label ``invalid-expression`` and its operands count one by one; an exception named on its own says nothing;
unknown identifiers keep their lower-cased name as label and count 0.3; repeated rows are scanned each; other
columns are not read. Texts are handled whole; a very long one costs time and memory in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from citeloom.llm import scan

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: How freely a text may be used under licences of each kind.
KINDS = {
    "public-domain": 1.0, "permissive": 0.9, "attribution": 0.8, "weak-copyleft": 0.6, "copyleft": 0.4,
    "network-copyleft": 0.35, "unknown": 0.3, "noncommercial": 0.2, "no-derivatives": 0.1, "reserved": 0.0,
}

#: Labels and their kinds.
LICENSES = {
    "gpl": "copyleft", "apache": "permissive", "cc-by": "attribution", "mit": "permissive",
    "lgpl": "weak-copyleft", "agpl": "network-copyleft", "mpl": "weak-copyleft", "epl": "weak-copyleft",
    "bsd": "permissive", "isc": "permissive", "zlib": "permissive", "boost": "permissive", "artistic": "weak-copyleft",
    "cc0": "public-domain", "unlicense": "public-domain", "public-domain": "public-domain",
    "cc-by-sa": "copyleft", "cc-by-nc": "noncommercial", "cc-by-nd": "no-derivatives", "cc-by-nc-sa": "noncommercial",
    "cc-by-nc-nd": "no-derivatives", "odbl": "weak-copyleft", "odc-by": "attribution", "gfdl": "copyleft",
    "all-rights-reserved": "reserved",
}

#: Notice phrases beyond the base ones, in words.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "gnu gpl": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "boost",
    "artistic license": "artistic",
    "permission is hereby granted free of charge": "mit",
    "expat license": "mit",
    "creative commons zero": "cc0",
    "cc0": "cc0",
    "unlicense": "unlicense",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "open database license": "odbl",
    "open data commons attribution license": "odc-by",
    "all rights reserved": "all-rights-reserved",
}

#: Exceptions: phrases that may follow ``with``.
EXCEPTIONS = {
    "classpath exception": "classpath-exception",
    "linking exception": "linking-exception",
    "llvm exception": "llvm-exception",
    "gcc runtime library exception": "gcc-exception",
    "font exception": "font-exception",
    "autoconf exception": "autoconf-exception",
}

#: Identifier tags, in words; the rest of the line is an expression.
TAGS = ("spdx license identifier", "license expression")

#: Identifiers of expressions by their first letters; the longest that fits names the licence.
IDENTIFIERS = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "gfdl": "gfdl", "apache": "apache", "mit": "mit", "expat": "mit", "x11": "mit",
    "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "zlib": "zlib", "bsl": "boost", "mpl": "mpl", "epl": "epl", "artistic": "artistic",
    "cc0": "cc0", "unlicense": "unlicense", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd", "odbl": "odbl", "odc-by": "odc-by",
}

OPERATORS = {"or": 1, "and": 2, "with": 3}
INVALID = "invalid-expression"
NO_STATEMENT = 0.5
#: Words between two operands of one expression, at most.
GAP = 12
#: Words that go with a licence's name.
FILLERS = frozenset(
    "a an any at by clause either both later of option its license licenses licence modified new revised simplified terms the "
    "under unported international intl generic v version your 0 1 2 3 4 5".split())
_OR_LATER = re.compile(r"\bor (?:at your option )?(?:any )?(?:later|newer)\b")


@dataclass(frozen=True)
class Operand:
    """A licence or an exception in an expression."""

    label: str
    exception: bool = False

    def value(self) -> float:
        return KINDS[LICENSES.get(self.label, "unknown")]


class ExpressionError(ValueError):
    """An expression that isn't one."""


def identifier(token: str) -> Operand:
    """The licence that an identifier such as ``Apache-2.0`` or ``GPL-2.0-or-later`` names."""
    name = token.lower().rstrip("+")
    if "exception" in name:
        return Operand(name, True)
    fits = [p for p in IDENTIFIERS if name == p or name.startswith((p + "-", p + ".", p + "_"))]
    return Operand(IDENTIFIERS[max(fits, key=len)] if fits else name)


def to_postfix(tokens: list) -> list:
    """Shunting-yard: operands, operators and brackets in reading order to operands and operators in postfix order."""
    out, held = [], []
    wanted = True  # an operand comes next
    for token in tokens:
        if isinstance(token, Operand):
            if not wanted:
                raise ExpressionError("two operands in a row")
            out.append(token)
            wanted = False
        elif token == "(":
            if not wanted:
                raise ExpressionError("a bracket after an operand")
            held.append(token)
        elif token == ")":
            if wanted:
                raise ExpressionError("nothing before a bracket")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ExpressionError("no bracket open")
            held.pop()
        else:
            if wanted:
                raise ExpressionError("nothing before an operator")
            while held and held[-1] != "(" and OPERATORS[held[-1]] >= OPERATORS[token]:
                out.append(held.pop())
            held.append(token)
            wanted = True
    if wanted or "(" in held:
        raise ExpressionError("the end is missing")
    return out + held[::-1]


def evaluate(tokens: list) -> float:
    """How freely a text under the expression may be used."""
    stack: list[tuple[float, bool]] = []
    for token in to_postfix(tokens):
        if isinstance(token, Operand):
            stack.append((token.value(), token.exception))
            continue
        (right, excepts), (left, wrong) = stack.pop(), stack.pop()
        if token == "with":
            if wrong or not excepts:
                raise ExpressionError("no exception after with")
            stack.append((max(left, (left + KINDS["permissive"]) / 2), False))
        elif wrong or excepts:
            raise ExpressionError("an exception alone")
        else:
            stack.append((max(left, right) if token == "or" else min(left, right), False))
    value, exception = stack[0]
    if exception:
        raise ExpressionError("an exception alone")
    return value


_HEAD = re.compile(rb"[ \t:=\"']*")
_TOKEN = re.compile(rb"[ \t]*([A-Za-z0-9](?:[A-Za-z0-9.+_-]*[A-Za-z0-9+])?|[()])")


def tag_tokens(raw: bytes, start: int) -> list:
    """The expression after a tag that ends at byte ``start``; it ends with the line, with a sign that
    expressions don't have, or where an operand follows an operand.
    """
    tokens: list = []
    at = _HEAD.match(raw, start).end()
    while (match := _TOKEN.match(raw, at)) is not None:
        word, at = match[1].decode(), match.end()
        token = word.lower() if word.lower() in OPERATORS or word in "()" else identifier(word)
        if isinstance(token, Operand) and tokens and (isinstance(tokens[-1], Operand) or tokens[-1] == ")"):
            break
        tokens.append(token)
    return tokens


@dataclass
class Found:
    """What one text says about its licence."""

    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base_labels: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    score: float = NO_STATEMENT
    n_expressions: int = 0


class Scanner:
    """The automaton over all phrases; built in each task."""

    def __init__(self) -> None:
        entries: dict[str, dict] = {}
        for kind, phrases in (("base", BASE), ("notice", BASE | NOTICES), ("exception", EXCEPTIONS), ("tag", dict.fromkeys(TAGS, ""))):
            for phrase, label in phrases.items():
                entries.setdefault(phrase, {"words": phrase.count(" ") + 1, "size": len(phrase) + 2})[kind] = label
        self.automaton = ahocorasick.Automaton()
        for phrase, entry in entries.items():
            self.automaton.add_word(f" {phrase} ", entry)
        self.automaton.make_automaton()

    def scan(self, words: str, raw: Callable[[], bytes], ends: np.ndarray) -> Found:
        """``words`` are joined by blanks, with one at each end; word ``k`` ends at byte ``ends[k]`` of the raw text."""
        found, names, tokens = Found(), [], None
        at = word = 0
        for end, entry in self.automaton.iter(words):
            # The blank that ends a hit; hits come in the order of their ends.
            word += words.count(" ", at, end)
            at = end
            first = word - entry["words"]
            if "base" in entry:
                found.n_base += 1
                found.first_word = first if found.first_word is None else min(found.first_word, first)
                found.last_word = first if found.last_word is None else max(found.last_word, first)
                found.base_labels.add(entry["base"])
            if "tag" in entry:
                self._add(found, tag_tokens(raw(), int(ends[word - 1])))
            elif "exception" in entry:
                names.append((first, word, Operand(entry["exception"], True)))
            else:
                names.append((first, word, Operand(entry["notice"])))
        stop = 0
        for first, end, operand in sorted(names, key=lambda n: (n[0], -n[1])):
            if tokens is not None and first < stop:
                continue
            joined = self._connector(words, tokens, stop, first)
            if joined is None:
                if tokens is not None:
                    self._add(found, tokens)
                tokens = [operand]
            else:
                tokens += [joined, operand]
            stop = end
        if tokens is not None:
            self._add(found, tokens)
        found.labels |= found.base_labels
        return found

    def _connector(self, words: str, tokens: list | None, stop: int, first: int) -> str | None:
        """The operator between two operands, if they belong to one expression."""
        if tokens is None or first - stop > GAP:
            return None
        # The place of word `stop` is remembered from the last call; both only move on.
        between = _OR_LATER.sub("", " ".join(self._words(words, stop, first))).split()
        joints = [w for w in between if w in OPERATORS]
        return joints[0] if len(joints) == 1 and all(w in FILLERS or w in OPERATORS for w in between) else None

    def _words(self, words: str, start: int, stop: int) -> list[str]:
        if self._text is not words or start < self._word:
            self._text, self._word, self._at = words, 0, 1
        while self._word < start:
            self._at = words.index(" ", self._at) + 1
            self._word += 1
        out, at = [], self._at
        for _ in range(stop - start):
            end = words.index(" ", at)
            out.append(words[at:end])
            at = end + 1
        return out

    _text, _word, _at = None, 0, 1

    def _add(self, found: Found, tokens: list) -> None:
        operands = [t for t in tokens if isinstance(t, Operand)]
        if tokens and all(t.exception for t in operands) and len(operands) == len(tokens):
            return  # an exception named on its own says nothing
        found.labels |= {t.label for t in operands}
        found.n_expressions += 1
        try:
            value = evaluate(tokens)
        except ExpressionError:
            found.labels.add(INVALID)
            value = min((t.value() for t in operands if not t.exception), default=KINDS["unknown"])
        found.score = value if found.n_expressions == 1 else min(found.score, value)


def _folded(part: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """``(words joined by blanks, raw bytes, word ends)`` of each text of a batch."""
    data, offsets = scan.text_bytes(part.column(part.schema.get_field_index("text")))
    lower = scan.LOWER[data]
    _, ends, row = scan.spans(lower, offsets, scan.LETTERS)
    inside = scan.LETTERS[lower]
    # One blank after each word, nothing else between them.
    keep = inside.copy()
    keep[ends[ends < len(data)]] = True
    plain = np.where(inside, lower, np.uint8(0x20))[keep]
    place = np.concatenate([[0], np.cumsum(keep)])
    bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
    for r in range(part.num_rows):
        a, b = int(bounds[r]), int(bounds[r + 1])
        low, high = int(offsets[r]), int(offsets[r + 1])
        text = plain[place[low] : place[high]].tobytes().decode().strip(" ")
        yield f" {text} " if b > a else " ", data[low:high], ends[a:b] - low


def _scan_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        for part in scan.slices(batch, "text"):
            sizes, rows = [], []
            for words, data, ends in _folded(part):
                sizes.append(len(ends))
                rows.append(scanner.scan(words, lru_cache(1)(data.tobytes), ends))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array([f.n_base for f in rows], pa.int64()),
                 pa.array([f.first_word for f in rows], pa.int64()), pa.array([f.last_word for f in rows], pa.int64()),
                 pa.array([sorted(f.base_labels) for f in rows], pa.list_(pa.string())),
                 pa.array([sorted(f.labels) for f in rows], pa.list_(pa.string())),
                 pa.array([f.score for f in rows], pa.float64()), pa.array([f.n_expressions for f in rows], pa.int64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_expressions"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_expressions)``, a row per row of ``docs``.

    Labels are sorted arrays without repeats.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan_part, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, n_expressions long")
