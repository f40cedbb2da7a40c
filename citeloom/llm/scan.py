"""Words and 64-bit hashes of whole Arrow text columns, by NumPy on their bytes.

UTF-8 keeps ASCII separators apart from other characters, so words are found
on bytes. Hashes stand for their words: at 64 bits two different words of a
text meet with a probability below 1e-9 for any text under 100,000 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer text is hashed in pieces cut between words.
PIECE = 1 << 17
#: Bytes of text handed to an operator at once; one longer text comes alone.
SLICE = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

SPACE = np.ones(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False

LETTERS = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    LETTERS[_low : _high + 1] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


class _Powers:
    """Powers of an odd multiplier and of its inverse; made once in a worker, never sent."""

    def __init__(self) -> None:
        self.tables: tuple[np.ndarray, np.ndarray] | None = None

    def __reduce__(self) -> tuple:
        return _Powers, ()

    def get(self) -> tuple[np.ndarray, np.ndarray]:
        if self.tables is None:
            def powers(base: int) -> np.ndarray:
                out = np.ones(PIECE + 1, np.uint64)
                out[1:] = np.uint64(base)
                return np.multiply.accumulate(out)

            self.tables = powers(_MULTIPLIER), powers(pow(_MULTIPLIER, -1, 1 << 64))
        return self.tables


_POWERS = _Powers()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text each."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, row)`` of all words; ``inside`` tells which bytes belong to one."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    mask = inside[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(mask)
    before[0] = False
    before[1:] = mask[:-1]
    before[edges] = False
    after = np.empty_like(mask)
    after[-1] = False
    after[:-1] = mask[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per span of bytes; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    power, inverse = _POWERS.get()
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + PIECE, "right"))
        if last == first:
            out[first] = _long_hash(data[starts[first] : ends[first]])
            first += 1
            continue
        low, high = int(starts[first]), int(ends[last - 1])
        running = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * power[: high - low], out=running[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((running[e] - running[s]) * inverse[s] + (e - s).astype(np.uint64))
        first = last
    return out


def _long_hash(data: np.ndarray) -> np.uint64:
    """The hash of one span above ``PIECE``; the same in every run."""
    power, _ = _POWERS.get()
    total = 0
    for k, low in enumerate(range(0, len(data), PIECE)):
        part = data[low : low + PIECE]
        total = (total * _MULTIPLIER + int(np.sum(_BYTE[part] * power[: len(part)], dtype=np.uint64)) + k) & _MASK
    return mix(np.array([total + len(data) & _MASK], np.uint64))[0]


def runs_of(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(_MULTIPLIER) + values[k : k + n]
    return mix(total)


def shingles(words: np.ndarray, row: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of each ``width`` consecutive words of a row.

    A row of fewer words, but not none, has one shingle of all its words.
    """
    rolled = runs_of(words, width)
    inner = row[: len(rolled)]
    keep = inner == row[width - 1 :] if len(rolled) else np.zeros(0, bool)
    made, owner = rolled[keep], inner[keep]
    counts = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        begins = np.concatenate([[0], np.cumsum(counts)])
        extra = np.array([runs_of(words[begins[i] : begins[i + 1]], int(counts[i]))[0] for i in short], np.uint64)
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        made, owner = np.concatenate([made, extra])[order], owner[order]
    return made, owner


def repeats(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: is it found in its row more than once, and did it come before?"""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    same = (v[1:] == v[:-1]) & (r[1:] == r[:-1])
    again = np.zeros(len(values), bool)
    several = np.zeros(len(values), bool)
    again[order[1:]] = same
    several[order[1:]] = same
    several[order[:-1]] |= same
    return several, again
