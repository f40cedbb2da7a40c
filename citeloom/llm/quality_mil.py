"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of 64 words; only the document has a label. Every
passage is encoded from its bytes and words (shares of each ASCII sign and of byte
classes, word lengths, repetition, hashed words), a layer learnt with the rest turns
that into a vector, gated attention weighs the passages, and the weighted vector is scored:
``a_k ∝ exp(w · (tanh(V h_k) * sigmoid(U h_k)))``, ``p = sigmoid(c · Σ a_k h_k + b)``.

Learning uses a sample of at most ``per_class`` documents of each label, none of them
held out and none above ``max_chars``; its passages go to the driver, where Adam fits
the small model in NumPy. The sample is balanced, so the intercept is set back to the share
of labels in all learnable rows. Scoring runs in the tasks, over whole texts.

Defined cases: null counts as the empty text; a text without words is one passage of
its bytes; without labels every score is 0.5, with one label only it is that label's value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from citeloom.llm import scan
from citeloom.llm.labels import class_counts, training_sample

PASSAGE = 64
PER_CLASS = 2048
MAX_CHARS = 100_000
HASHED = 16

_SIGNS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
#: Byte classes: one per sign, then lower, upper, digit, line break, other space or control, lead byte, later byte.
_CLASS = np.full(256, len(_SIGNS) + 4, np.int64)
_CLASS[_SIGNS] = np.arange(len(_SIGNS))
for _k, (_a, _b) in enumerate(((0x61, 0x7B), (0x41, 0x5B), (0x30, 0x3A), (0x0A, 0x0B))):
    _CLASS[_a:_b] = len(_SIGNS) + _k
_CLASS[0xC0:] = len(_SIGNS) + 5
_CLASS[0x80:0xC0] = len(_SIGNS) + 6
_CLASSES = len(_SIGNS) + 7
FEATURES = _CLASSES + 6 + HASHED


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(vectors, row)`` of all passages of a column of texts; each row has at least one."""
    data, offsets = scan.text_bytes(column)
    n_rows = len(offsets) - 1
    starts, ends, row = scan.spans(data, offsets, scan.SPACE)
    words = scan.hashes(data, starts, ends)
    counts = np.bincount(row, minlength=n_rows)
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    in_row = np.arange(len(row)) - firsts[row]
    per_row = np.maximum(-(-counts // PASSAGE), 1)
    bases = np.concatenate([[0], np.cumsum(per_row)])
    total = int(bases[-1])
    owner = np.repeat(np.arange(n_rows), per_row)
    of_word = bases[row] + in_row // PASSAGE
    # A passage runs from its first word to that of the next one; the first one has the start of the text too.
    begin = offsets[owner].copy()
    heads = np.flatnonzero((in_row % PASSAGE == 0) & (in_row > 0))
    begin[of_word[heads]] = starts[heads]
    lengths = np.diff(np.append(begin, offsets[-1]))
    of_byte = np.repeat(np.arange(total), lengths)
    shares = np.bincount(of_byte * _CLASSES + _CLASS[data], minlength=total * _CLASSES).reshape(total, _CLASSES)
    out = np.zeros((total, FEATURES), np.float32)
    out[:, :_CLASSES] = np.sqrt(shares / np.maximum(lengths, 1)[:, None])
    n = np.bincount(of_word, minlength=total)
    safe = np.maximum(n, 1)
    size = (ends - starts).astype(np.float64)
    mean = np.bincount(of_word, size, total) / safe
    square = np.bincount(of_word, size * size, total) / safe
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    _, in_passage = scan.repeats(words, of_word)
    triples = scan.runs_of(words, 3)
    own = np.flatnonzero(row[: len(triples)] == row[2:]) if len(triples) else np.zeros(0, np.int64)
    several, _ = scan.repeats(triples[own], row[own])
    extra = (np.log1p(mean), np.sqrt(np.maximum(square - mean * mean, 0)) / 8, np.bincount(of_word, same, total) / safe,
             np.bincount(of_word, in_passage, total) / safe,
             np.bincount(of_word[own], several, total) / safe, np.log1p(n) / 4)
    for k, values in enumerate(extra):
        out[:, _CLASSES + k] = values
    bucket = (words % np.uint64(HASHED)).astype(np.int64)
    hashed = np.bincount(of_word * HASHED + bucket, minlength=total * HASHED).reshape(total, HASHED)
    out[:, -HASHED:] = np.sqrt(hashed / safe[:, None])
    return out, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Parameters by name; ``shift`` moves the balanced sample's intercept to the share in all labels."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES, np.float32))
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0
    constant: float | None = None

    def _forward(self, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> tuple:
        w = self.weights
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        g = (t * s) @ w["w"]
        g = np.exp(g - np.maximum.reduceat(g, first)[bag])
        a = g / np.add.reduceat(g, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        return h, t, s, a, z, z @ w["c"] + w["b"][0]

    def score(self, x: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """One score per bag; ``owner`` numbers the bags 0, 1, … in order."""
        if not len(owner):
            return np.zeros(0)
        if self.constant is not None:
            return np.full(int(owner[-1]) + 1, self.constant)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        logit = self._forward((x - self.mean) / self.scale, first, owner)[-1]
        return _sigmoid(logit + self.shift)


def fit(bags: list[np.ndarray], labels: np.ndarray, shift: float, epochs: int = 25, rate: float = 0.01,
        hidden: int = 24, gate: int = 12, decay: float = 1e-3, batch: int = 128, seed: int = 0) -> Model:
    """Adam on the cross-entropy of whole bags."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    model = Model(every.mean(0), every.std(0) + 0.05, shift=shift)
    shapes = {"E": (FEATURES, hidden), "e": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "b": (1,)}
    model.weights = {k: (rng.normal(0, 1 / math.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s)).astype(np.float32)
                     for k, s in shapes.items()}
    first_moment = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second_moment = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = np.array([len(bags[i]) for i in chosen])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            bag = np.repeat(np.arange(len(chosen)), sizes)
            x = (np.concatenate([bags[i] for i in chosen]) - model.mean) / model.scale
            grads = _gradients(model, x, first, bag, labels[chosen])
            step += 1
            for k, g in grads.items():
                g = g + decay * model.weights[k]
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * g * g
                up = first_moment[k] / (1 - 0.9**step)
                model.weights[k] -= (rate * up / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _gradients(model: Model, x: np.ndarray, first: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    w = model.weights
    h, t, s, a, z, logit = model._forward(x, first, bag)
    d_logit = (_sigmoid(logit) - y) / len(y)
    d_z = (d_logit[:, None] * w["c"])[bag]
    d_a = (h * d_z).sum(1)
    d_g = a * (d_a - np.add.reduceat(a * d_a, first)[bag])
    d_ts = d_g[:, None] * w["w"]
    d_t, d_s = d_ts * s * (1 - t * t), d_ts * t * s * (1 - s)
    d_h = (a[:, None] * d_z + d_t @ w["V"].T + d_s @ w["U"].T) * (1 - h * h)
    return {"E": x.T @ d_h, "e": d_h.sum(0), "V": h.T @ d_t, "U": h.T @ d_s, "w": (t * s).T @ d_g,
            "c": z.T @ d_logit, "b": np.array([d_logit.sum()])}


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch, "text"):
            x, owner = encode(part.column(1))
            sizes = np.bincount(owner, minlength=part.num_rows)
            ends = np.cumsum(sizes)
            packed = [x[e - n : e].astype(np.float16).tobytes() for e, n in zip(ends, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(packed, pa.binary())], names=["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS,
          max_chars: int = MAX_CHARS) -> Model:
    """Fit on a bounded sample; at most ``2 * per_class`` documents reach the driver, as passage vectors."""
    counts = class_counts(labels, label)
    if len(counts) < 2:
        return Model(constant=float(next(iter(counts))) if counts else 0.5)
    sample = training_sample(docs, labels, label, per_class, max_chars)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(_encoded, f"doc_id {kind}, y int, x binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["y"] for r in rows], np.float32)
    if not 0 < y.sum() < len(y):
        return Model(constant=float(y[0]) if len(y) else 0.5)
    bags = [np.frombuffer(r["x"], np.float16).astype(np.float32).reshape(-1, FEATURES) for r in rows]
    shift = math.log(counts[1] / counts[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return fit(bags, y, shift)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` of scores, that replaces one of this name."""
    columns = [c for c in docs.columns if c.lower() != name.lower()]
    kept = docs.select(*columns)
    place = columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, "text"):
                made = model.score(*encode(part.column(place)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.float64())], names=[*columns, name])

    return kept.mapInArrow(scored, StructType([*kept.schema.fields, StructField(name, DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score at least ``threshold``; columns as they came."""
    return score(docs, train(docs, labels), "__score").where(F.col("__score") >= threshold).select(*docs.columns)
