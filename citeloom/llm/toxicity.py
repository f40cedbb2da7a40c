"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, takes accents off, maps Cyrillic, Greek, full-width and
mathematical look-alikes to Latin letters, digits and signs inside words to the letters
they replace, drops invisible characters, and merges ``l`` with ``i`` since ``1`` and ``|``
stand for both. Lexicon and text are folded alike.

The lexicon is learnt: whole words and word starts whose share of toxic documents is
well above that of others, each with its log ratio as weight; of nested starts the one that
stays when a longer one covers as much. Words under a learnt start that are mostly harmless become
exception phrases, beside those given; a hit inside one doesn't count.

The weights of the terms hit, damped where one term repeats, and the same divided by the
root of the number of words, go through a logistic function that is calibrated on the sample and set back to the share of labels.

Learning uses at most ``per_class`` documents of each label, none held out, none above
``max_chars``, and keeps at most ``MAX_TERMS`` terms. Defined cases: null counts as the
empty text; an empty text has no hits and the score of harmless texts; without labels every
score is 0, with one label only it is that label's value.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm import scan
from citeloom.llm.labels import class_counts, training_sample

PER_CLASS = 2048
MAX_CHARS = 100_000
MAX_TERMS = 5000
#: Least log-likelihood ratio of a learnt term; chance gives one in a million that.
SURPRISE = 24.0
STARTS = range(4, 8)
#: Harmless words that hold an insult.
EXCEPTIONS = ("scunthorpe", "cockpit", "cocktail", "peacock", "shuttlecock", "dickens", "class clown fish", "trash can")

#: Look-alikes and the letters they stand for.
_CYRILLIC = dict(zip("авсеёһіїјкмнорԛѕтухԝгпи", "abceehiijkmhopqstyxwrnu", strict=True))
_GREEK = dict(zip("αβγδεζηικλμνοπρστυχω", "abydezniklmvonpstuxw", strict=True))
_DIGITS = dict(zip("01345789", "oieastbg", strict=True))
_SIGNS = dict(zip("@$!|+", "asiit", strict=True))
_INSIDE = re.compile(r"(?<=[^\W_])[@$!|+](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    ranges = ((0xC0, 0x250), (0x1E00, 0x1F00), (0xFF01, 0xFF5F), (0x1D400, 0x1D800))
    for code in (c for a, b in ranges for c in range(a, b)):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x)).lower()
        if base and base != chr(code):
            table[code] = base
    table |= {ord(k): v for k, v in (*_CYRILLIC.items(), *_GREEK.items(), *_DIGITS.items())}
    table |= dict.fromkeys((*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
    table[0x131] = "i"
    final = str.maketrans(_DIGITS | {"l": "i"})
    return {k: None if v is None else v.translate(final) for k, v in (table | {ord("l"): "i"}).items()}


_TABLE = _fold_table()


def fold(text: str) -> str:
    text = text.lower()
    if any(s in text for s in _SIGNS):
        text = _INSIDE.sub(lambda m: _SIGNS[m[0]], text)
    return text.translate(_TABLE)


@dataclass
class Lexicon:
    """Folded terms: weights of whole words and of word starts, exceptions, and the calibration."""

    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    calibration: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """The automaton of a lexicon; built in each task."""

    def __init__(self, lexicon: Lexicon):
        entries: dict[str, list] = {}
        for term, weight in lexicon.words.items():
            entries.setdefault(term, [len(term), None, None, False])[1] = weight
        for term, weight in lexicon.starts.items():
            entries.setdefault(term, [len(term), None, None, False])[2] = weight
        for term in lexicon.exceptions:
            entries.setdefault(term, [len(term), None, None, False])[3] = True
        self.automaton = ahocorasick.Automaton()
        for term, entry in entries.items():
            self.automaton.add_word(term, tuple(entry))
        if entries:
            self.automaton.make_automaton()
        self.empty = not entries

    def hits(self, folded: str) -> dict[str, tuple[float, int]]:
        """Weight and number of hits of each term found outside exceptions."""
        if self.empty:
            return {}
        found, covered, size = [], [], len(folded)
        for end, (length, word, start, exception) in self.automaton.iter(folded):
            begin = end - length + 1
            if begin and folded[begin - 1].isalnum():
                continue
            closed = end + 1 == size or not folded[end + 1].isalnum()
            if exception and closed:
                covered.append((begin, end))
            weight = word if word is not None and closed else start
            if weight is not None:
                found.append((begin, end, weight))
        if covered:
            found = [f for f in found if not any(a <= f[0] and f[1] <= b for a, b in covered)]
        best: dict[int, tuple[float, int]] = {}
        for begin, end, weight in found:
            best[begin] = max(best.get(begin, (-math.inf, 0)), (weight, end))
        terms: dict[str, tuple[float, int]] = {}
        for begin, (weight, end) in best.items():
            term = folded[begin : end + 1]
            terms[term] = (weight, terms.get(term, (weight, 0))[1] + 1)
        return terms


def _measures(terms: dict[str, tuple[float, int]], n_words: int) -> tuple[float, float]:
    """The sum of weights, damped for one term that is repeated, as its logarithm and by length."""
    total = max(sum(w * (1 + math.log(n)) for w, n in terms.values()), 0.0)
    return math.log1p(total), total / math.sqrt(max(n_words, 1))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word or a word start (marked by a last ``*``)."""
    counts = Counter(), Counter()
    for batch in batches:
        for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = set(_WORD.findall(fold(text or "")))
            counts[y].update(words)
            counts[y].update({w[:n] + "*" for w in words for n in STARTS if len(w) > n})
    terms = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)],
        names=["term", "n0", "n1"])


def choose_terms(rows: list[tuple[str, int, int]], n0: int, n1: int) -> tuple[dict, dict]:
    """``(words, starts)`` with weights, from ``(term, n0, n1)`` of the terms that stand out."""
    weight = {t: math.log((b + 0.5) / (n1 + 1)) - math.log((a + 0.5) / (n0 + 1)) for t, a, b in rows}
    toxic = {t: b for t, _, b in rows}
    words, starts = {}, {}
    for term in sorted((t for t in weight if t.endswith("*")), key=lambda t: (-len(t), t)):
        longer = max((toxic[t] for t in toxic if t != term and t.startswith(term[:-1])), default=0)
        if longer < 0.9 * toxic[term]:
            starts[term[:-1]] = weight[term]
    for term in (t for t in weight if not t.endswith("*")):
        above = [weight[term[:n] + "*"] for n in STARTS if term[:n] in starts]
        if not above or weight[term] > max(above) + 0.3:
            words[term] = weight[term]
    for start in list(starts):
        if any(start[:n] in starts and weight[start[:n] + "*"] >= weight[start + "*"] - 0.3 for n in STARTS if n < len(start)):
            del starts[start]
    return words, starts


def _surprise(n0: int, n1: int) -> Column:
    """The log-likelihood ratio by which a term's documents depart from the same share in both labels."""
    a, b = F.col("n0").cast("double"), F.col("n1").cast("double")
    share = (a + b) / (n0 + n1)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / F.greatest(expected, F.lit(1e-9)))).otherwise(0.0)

    return 2 * (part(a, share * n0) + part(b, share * n1)
                + part(F.lit(float(n0)) - a, (1 - share) * n0) + part(F.lit(float(n1)) - b, (1 - share) * n1))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS,
          min_share: float = 0.01, min_ratio: float = 4.0, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon and calibration from a bounded sample of labelled documents."""
    counts = class_counts(labels, label)
    if len(counts) < 2:
        return Lexicon(constant=float(next(iter(counts))) if counts else 0.0)
    sample = training_sample(docs, labels, label, per_class, max_chars)
    n0, n1 = (min(counts[y], per_class) for y in (0, 1))
    terms = sample.mapInArrow(_count_terms, "term string, n0 long, n1 long").groupBy("term").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    ratio = ((F.col("n1") + 0.5) / (n1 + 1)) / ((F.col("n0") + 0.5) / (n0 + 1))
    least = max(2, math.ceil(min_share * n1))
    standing = terms.where((F.col("n1") >= least) & (ratio >= min_ratio) & (_surprise(n0, n1) >= SURPRISE)).orderBy(F.desc("n1"), "n0", "term").limit(MAX_TERMS)
    words, starts = choose_terms([tuple(r) for r in standing.collect()], n0, n1)
    given = {fold(e) for e in exceptions}
    harmless = terms.where((F.col("n0") >= least) & (ratio <= 1) & ~F.col("term").endswith("*"))
    if starts:
        under = F.lit(False)
        for n in STARTS:
            same = [s for s in starts if len(s) == n]
            under = under | F.substring("term", 1, n).isin(same) if same else under
        given |= {r["term"] for r in harmless.where(under).orderBy(F.desc("n0"), "term").limit(MAX_TERMS).collect()}
    lexicon = Lexicon(words, starts, tuple(sorted(given)))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            made = []
            for text in batch.column(1).to_pylist():
                folded = fold(text or "")
                made.append(_measures(matcher.hits(folded), len(folded.split())))
            a, b = zip(*made, strict=True) if made else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(a, pa.float64()), pa.array(b, pa.float64())], names=["doc_id", "y", "a", "b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(measured, f"doc_id {kind}, y int, a double, b double").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    lexicon.calibration = _calibrate(np.array([(r["a"], r["b"]) for r in rows]), np.array([r["y"] for r in rows]), counts[1] / counts[0])
    return lexicon


def _calibrate(x: np.ndarray, y: np.ndarray, odds: float, ridge: float = 0.01) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps; its intercept is moved to the odds in all labels."""
    if not 0 < y.sum() < len(y):
        return 0.0, 0.0, 0.0
    design = np.column_stack([np.ones(len(x)), x])
    beta, keep = np.zeros(3), np.array([0.0, ridge, ridge]) * len(x) / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - keep * beta
        curve = (design * (p * (1 - p) + 1e-6)[:, None]).T @ design + np.diag(keep + 1e-9)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    beta[0] += math.log(odds) - math.log(y.sum() / (len(y) - y.sum()))
    return tuple(float(b) for b in beta)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score, n_hits, n_words`` of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        b0, b1, b2 = lexicon.calibration
        for batch in batches:
            for part in scan.slices(batch, "text"):
                scores, hits, words = [], [], []
                for text in part.column(1).to_pylist():
                    folded = fold(text or "")
                    found, n = matcher.hits(folded), len(folded.split())
                    a, b = _measures(found, n)
                    x = min(max(b0 + b1 * a + b2 * b, -40.0), 40.0)
                    scores.append(1 / (1 + math.exp(-x)) if lexicon.constant is None else lexicon.constant)
                    hits.append(sum(k for _, k in found.values()))
                    words.append(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()), pa.array(hits, pa.int64()), pa.array(words, pa.int64())],
                    names=["doc_id", "score", "n_hits", "n_words"])

    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double, n_hits long, n_words long")
