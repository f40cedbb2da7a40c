"""Substring dedup: near-duplicate passages by compact windows.

Tokens are shingles of five words (A–Z lower-cased; letters, digits, non-ASCII). Texts are
worked on in segments of 1024 shingles that overlap by 128, so a very long text is many bounded
units and every passage of up to 128 shingles lies whole in one.

A node of the Cartesian tree of a sequence of hashes is a compact window ``(a, c, b)``: all
subsequences that start in ``a..c`` and end in ``c..b`` have ``c`` as their min-hash. The sequence
here is a segment's runs of 12 tokens (16 words), and windows span 10 runs, so that every 21 tokens
in a row hold the ``c`` of a window, and there are about ``2 n / 11`` windows. The key of a window is its min-hash.

Two texts that share 21 tokens in a row share that window's key, whatever is around it. Of
46 tokens with 41 in the other text, 21 are in a row: an edit inside costs at least four tokens, so
there is one at most, and it leaves two runs. So every pair that the verification accepts is a
candidate, by one hash function and without chance. Only where phrases of four words or more
repeat on the spot can lost tokens lie in more than one place.

Units of one key are joined with one leader, the first document, which is a linear number
of pairs; pairs are verified on whole segments: of the tokens in 46-token intervals, at
least 41 must lie in the other segment, and the passage there must have a Jaccard similarity of
0.8 or more. A window whose 12 tokens no verified passage covers whole is
compared with the same key's windows of all earlier documents by the same rule: inside tasks, the 45
tokens on each side of ``c`` with 68 and more on each side in the other text, which leaves room for inserted words. Of 46 tokens five may be
missing in the other text, so it has one of any six; the six that fewest documents of the task have are
looked up, so a frequent line between unlike texts is compared with nothing, and places of one unit are compared together.
A key of up to 2048 units is one group of a task. One of more is dealt by the tokens looked up, a group for each, which is a
linear number of rows; only where more than 2048 units of such a group are open, pairs of blocks are compared.
So no candidate is left out, no pairs of a group are laid out as
rows, and a task returns at most the passages of one source for each of its windows.

The first document (by ``doc_id``) keeps a passage, later ones lose it. Equal texts of 50 words
or more are whole repeats of their first document. An edge stays at most nine words short of the longest passage that
an earlier document has: ten more tokens hold a key that reaches over the edge, and its window is open.

Defined cases: null counts as the empty text; texts under 50 words have no passage; repeats
inside one document aren't looked for; null ids come after all others; rows of equal id and text are
one document, of which :func:`remove_passages` leaves one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import scan
from citeloom.llm.dart_minhash import node_of, row_key
from citeloom.llm.graphs import written

SHINGLE = 5
#: Tokens of a passage of 50 words, and how many of them must be shared for a Jaccard similarity of 0.8.
TOKENS = 46
SHARED = 41
THRESHOLD = 0.8
SEGMENT, OVERLAP = 1024, 128
#: Tokens of a key, and runs of a window: RUN + REACH - 1 tokens in a row, half of SHARED, always hold a key.
RUN, REACH = 12, 10
#: Tokens around c: those a passage of TOKENS can reach, and in the other text up to a quarter of both sides more.
NEAR, WIDE = TOKENS - 1, TOKENS - 1 + 23
#: Units of one key that are compared in one group.
BLOCK = 2048

_SEEDS = scan.mix(np.arange(101, 110, dtype=np.uint64))


def compact_windows(values: np.ndarray, least: int = TOKENS) -> list[tuple[int, int, int]]:
    """``(a, c, b)`` of all compact windows of at least ``least`` tokens; bounds included."""
    out, todo = [], [(0, len(values))]
    while todo:
        low, high = todo.pop()
        if high - low < least:
            continue
        c = low + int(values[low:high].argmin())
        out.append((low, c, high - 1))
        todo.append((low, c))
        todo.append((c + 1, high))
    return out


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, bounds)``: the shingles of all texts, one after the other."""
    data, offsets = scan.text_bytes(column)
    data = scan.LOWER[data]
    starts, ends, row = scan.spans(data, offsets, scan.LETTERS)
    words = scan.hashes(data, starts, ends)
    rolled = scan.runs_of(words, SHINGLE)
    keep = row[: len(rolled)] == row[SHINGLE - 1 :] if len(rolled) else np.zeros(0, bool)
    counts = np.bincount(row[: len(rolled)][keep], minlength=len(offsets) - 1)
    return rolled[keep], np.concatenate([[0], np.cumsum(counts)])


def segments(n: int) -> Iterator[tuple[int, int, int]]:
    """``(number, start, stop)`` of the segments of ``n`` tokens."""
    start = number = 0
    while n - start >= TOKENS and (number == 0 or n - start > OVERLAP):
        yield number, start, min(start + SEGMENT, n)
        number, start = number + 1, start + SEGMENT - OVERLAP


def centres(values: np.ndarray, least: int = REACH) -> np.ndarray:
    """Every ``c`` of :func:`compact_windows`; of equal values in reach, all."""
    if len(values) < least:
        return np.zeros(0, np.int64)
    lows = np.lib.stride_tricks.sliding_window_view(values, least).min(1)
    padded = np.zeros(len(lows) + 2 * (least - 1), values.dtype)
    padded[least - 1 : least - 1 + len(lows)] = lows
    # The minima of the subsequences that hold a place are at most its value.
    return np.flatnonzero(np.lib.stride_tricks.sliding_window_view(padded, least).max(1) == values)


def window_keys(tokens: np.ndarray, units: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(key, unit, place of c in the unit)`` of the windows of each unit ``(start, stop)``, by unit and place."""
    keys, units_of, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    runs = scan.mix(scan.runs_of(tokens, RUN) + _SEEDS[0])
    for u, (start, stop) in enumerate(units):
        found = centres(runs[start : stop - RUN + 1])
        keys.append(runs[start + found])
        units_of.append(np.full(len(found), u, np.int64))
        places.append(found)
    key, unit, place = np.concatenate(keys), np.concatenate(units_of), np.concatenate(places)
    return key, unit, place.astype(np.int32)


def _unit_names(nodes: list[bytes], numbers: list[int]) -> np.ndarray:
    heads = np.array([int.from_bytes(n[:8], "little") for n in nodes], np.uint64)
    return scan.mix(heads + np.array(numbers, np.uint64) * _SEEDS[-1])


def _units(part: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray, list[int], np.ndarray]:
    """``(tokens, spans, row, base, name)`` of all units of a batch ``(doc_id, node, text)``."""
    tokens, bounds = tokens_of(part.column(2))
    spans, rows, bases, numbers = [], [], [], []
    for r in range(part.num_rows):
        first = int(bounds[r])
        for number, start, stop in segments(int(bounds[r + 1]) - first):
            spans.append((first + start, first + stop))
            rows.append(r)
            bases.append(start)
            numbers.append(number)
    nodes = part.column(1)
    names = _unit_names([nodes[r].as_py() for r in rows], numbers) if rows else np.zeros(0, np.uint64)
    return tokens, spans, np.array(rows, np.int64), bases, names


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch, "text"):
            tokens, spans, rows, bases, names = _units(part)
            key, unit, place = window_keys(tokens, spans)
            ends = np.concatenate([[0], np.cumsum(np.bincount(unit, minlength=len(spans)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)), pa.array(names.view(np.int64)),
                 pa.array([base + b - a for base, (a, b) in zip(bases, spans, strict=True)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(key.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(place))],
                names=["doc_id", "node", "unit", "stop", "key", "place"])


#: Tokens are compared by 32 bits of their hashes: two that differ meet with a chance of 2e-10, and 41 must agree.
def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch, "text"):
            tokens, spans, rows, bases, names = _units(part)
            short = (tokens >> np.uint64(32)).astype(np.uint32)
            packed = [short[a:b].tobytes() for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [part.column(1).take(pa.array(rows)), pa.array(names.view(np.int64)), pa.array(bases, pa.int64()),
                 pa.array(packed, pa.binary())], names=["node", "unit", "base", "tokens"])


def shared_passages(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Token intervals of ``x`` that are near duplicates of a passage in ``y``."""
    order = np.argsort(y, kind="stable")
    ranked = y[order]
    at = np.minimum(np.searchsorted(ranked, x), len(y) - 1)
    inside = ranked[at] == x
    out: list[tuple[int, int]] = []
    for start, stop in _dense(inside):
        hit = np.flatnonzero(inside[start:stop]) + start
        start, stop = int(hit[0]), int(hit[-1]) + 1
        if stop - start < TOKENS:
            continue
        shift = order[at[hit]] - hit
        middle = int(np.sort(shift)[len(shift) // 2])
        close = np.abs(shift - middle) <= max(8, (stop - start) // 5)
        there = order[at[hit]][close]
        own = np.unique(x[start:stop])
        other = np.unique(y[int(there.min()) : int(there.max()) + 1])
        both = len(np.intersect1d(own, other, assume_unique=True))
        if both >= threshold * (len(own) + len(other) - both) - 1e-9:
            out.append((start, stop))
            continue
        # Runs of one token lie on the offset of their first one, which is the largest there.
        runs = [int(shift[k : k + TOKENS].max()) for k in range(0, len(shift), TOKENS // 2)]
        for d in dict.fromkeys([middle, *_frequent(shift), *runs]):
            a, b = max(start, -d), min(stop, len(y) - d)
            if b - a >= TOKENS:
                same = x[a:b] == y[a + d : b + d]
                trimmed = (np.flatnonzero(same[s:e]) + a + s for s, e in _dense(same))
                out += [(int(t[0]), int(t[-1]) + 1) for t in trimmed if t[-1] + 1 - t[0] >= TOKENS]
    return out


def _dense(hit: np.ndarray) -> list[tuple[int, int]]:
    """Unions of all intervals of TOKENS places of which SHARED are hit."""
    if len(hit) < TOKENS:
        return []
    total = np.concatenate([[0], np.cumsum(hit)])
    full = np.concatenate([[False], total[TOKENS:] - total[:-TOKENS] >= SHARED, [False]])
    edges = np.flatnonzero(full[1:] != full[:-1])
    out: list[tuple[int, int]] = []
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        stop = int(b) - 1 + TOKENS
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], stop)
        else:
            out.append((int(a), stop))
    return out


def _frequent(shift: np.ndarray) -> list[int]:
    """Every offset that enough tokens share."""
    values, counts = np.unique(shift, return_counts=True)
    return [int(v) for v in values[counts >= SHARED]]


_FOUND = "unit long, source_unit long, node binary, base long, start int, stop int, source binary"


def _pairs_verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        unit, leader, node, other, base, x, y = (batch.column(i) for i in range(7))
        for i in range(batch.num_rows):
            a, b = (np.frombuffer(v[i].as_buffer(), np.uint32) for v in (x, y))
            rows += [(i, s, e) for s, e in shared_passages(a, b)]
        at = pa.array([r[0] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [unit.take(at), leader.take(at), node.take(at), base.take(at), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.int32()), other.take(at)],
            names=["unit", "source_unit", "node", "base", "start", "stop", "source"])


def _aligned(x: np.ndarray, y: np.ndarray, d: int) -> list[tuple[int, int]]:
    """Token intervals of ``x`` that agree with ``y`` at one offset."""
    a, b = max(0, -d), min(len(x), len(y) - d)
    same = x[a:b] == y[a + d : b + d]
    trimmed = (np.flatnonzero(same[s:e]) + a + s for s, e in _dense(same))
    return [(int(t[0]), int(t[-1]) + 1) for t in trimmed if t[-1] + 1 - t[0] >= TOKENS]


def _rare_places(df: np.ndarray, ties: np.ndarray | None = None) -> np.ndarray:
    """Places of tokens of which every possible passage shares one, by ``df``, in how many documents a token is.

    A passage is TOKENS in a row of which at most TOKENS - SHARED are missing in the other text, so of one more
    than that any choice has a shared token; the rarest are chosen, of equal ones the least in ``ties``, numbers below 2 ** 32,
    so that overlapping passages choose the same. Tokens that no other text has can't be.
    """
    missing = TOKENS - SHARED
    if len(df) < TOKENS:
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(df < 2)])
    possible = np.flatnonzero(total[TOKENS:] - total[:-TOKENS] <= missing)
    if not len(possible):
        return possible
    rows = (df if ties is None else (df << 32) + ties)[possible[:, None] + np.arange(TOKENS)]
    rarest = np.argpartition(rows, missing, 1)[:, : missing + 1] + possible[:, None]
    return np.unique(rarest[df[rarest] > 1])


def _near_regions(places: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The unions of NEAR tokens on each side of the places."""
    out: list[tuple[int, int]] = []
    for p in places.tolist():
        low, high = max(p - NEAR, 0), min(p + NEAR + 1, size)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _reaches(intervals: list[tuple[int, int]], place: int) -> bool:
    """Does an interval have TOKENS of those around a place?"""
    return any(min(stop, place + NEAR + 1) - max(start, place - NEAR) >= TOKENS for start, stop in intervals)


def _at_offsets(x: np.ndarray, y: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """The passages of ``x`` that agree with ``y`` place by place, at any of the offsets."""
    out: list[tuple[int, int]] = []
    for d in _agreeing(x, y, offsets).tolist():
        out += _aligned(x, y, d)
    return out


def _long_enough(hit: np.ndarray) -> bool:
    """Are there TOKENS places or more from a hit to a hit, dense as in a passage?"""
    for start, stop in _dense(hit):
        own = np.flatnonzero(hit[start:stop])
        if own[-1] + 1 - own[0] >= TOKENS:
            return True
    return False


def _agreeing(x: np.ndarray, y: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Those of the offsets at which SHARED places agree or more; fewer are no passage."""
    order = np.argsort(y, kind="stable")
    ranked = y[order]
    first, last = np.searchsorted(ranked, x, "left"), np.searchsorted(ranked, x, "right")
    n = last - first
    at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
    agree = np.bincount(order[at] - np.repeat(np.arange(len(x)), n) + len(x) - 1, minlength=len(x) + len(y) - 1)
    return offsets[agree[offsets + len(x) - 1] >= SHARED]


def _block_verified(table: pa.Table) -> pa.Table:
    """For the open windows of one or two blocks of units, the passages each shares with the first earlier document that has one.

    With two blocks, only units of different blocks are compared.
    """
    ids, nodes = table.column("first").to_pylist(), table.column("node").to_pylist()
    low, block = table.column("low").to_numpy(), table.column("i").to_numpy()
    places, opened = ([np.sort(np.array(v, np.int64)) - q for v, q in zip(table.column(c).to_pylist(), low, strict=True)] for c in ("places", "open"))
    two = len(np.unique(block)) > 1
    texts = [np.frombuffer(t.as_buffer(), np.uint32) for t in table.column("tokens")]
    n, ends = len(texts), np.cumsum([len(t) for t in texts])
    owner = np.repeat(np.arange(n), [len(t) for t in texts])
    _, numbers = np.unique(np.concatenate(texts), return_inverse=True)
    # In which units a token is, each once, and in how many documents.
    held = np.unique(numbers.astype(np.int64) * n + owner)
    starts = np.concatenate([[0], np.cumsum(np.bincount(held // n))])
    holders = held % n
    names, document = np.unique(np.array(nodes, object), return_inverse=True)
    df = np.bincount(np.unique(held // n * len(names) + document[holders]) // len(names))
    known = np.zeros(len(df), bool)
    order = np.array(sorted(range(n), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, nodes[i])))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    rows = []
    for i in np.flatnonzero([len(p) > 0 for p in opened]):
        x, own = texts[i], numbers[ends[i] - len(texts[i]) : ends[i]]
        regions = _near_regions(opened[i], len(x))
        rare = np.concatenate([a + _rare_places(df[own[a:b]]) for a, b in regions]).astype(np.int64)
        tokens = np.unique(own[rare])
        if not len(tokens):
            continue
        others = np.unique(np.concatenate([holders[starts[t] : starts[t + 1]] for t in tokens]))
        others = others[(rank[others] < rank[i]) & (document[others] != document[i])]
        if two:
            others = others[block[others] != block[i]]
        left = opened[i].tolist()
        for j in others[np.argsort(rank[others])]:
            y, theirs = texts[j], numbers[ends[j] - len(texts[j]) : ends[j]]
            known[theirs] = True
            inside = known[own]
            known[theirs] = False
            dense = [(a + s, a + e) for a, b in regions for s, e in _dense(inside[a:b])]
            hot = [p for p in left if _reaches(dense, p)]
            if not hot:
                continue
            found = {(a + s, a + e) for a, b in _near_regions(np.array(hot), len(x)) for s, e in shared_passages(x[a:b], y)}
            # A passage that agrees place by place is as long among all tokens that one text has of the other.
            if not all(_reaches(list(found), p) for p in hot) and _long_enough(inside) and _long_enough(np.isin(y, x)):
                # It has one of the rare tokens at its offset.
                by_token = np.argsort(theirs, kind="stable")
                first, last = (np.searchsorted(theirs, own[rare], side, sorter=by_token) for side in ("left", "right"))
                at = np.arange((last - first).sum()) + np.repeat(first - np.cumsum(last - first) + (last - first), last - first)
                found.update(_at_offsets(x, y, np.unique(by_token[at] - np.repeat(rare, last - first))))
            left = [p for p in left if p not in hot or not _reaches(list(found), p)]
            rows += [(i, j, s, e) for s, e in sorted(found)]
            if not left:
                break
    i, j, start, stop = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 4
    own, other = table.take(pa.array(i)), table.take(pa.array(j))
    return pa.table({
        "unit": own.column("unit"), "source_unit": other.column("unit"), "node": own.column("node"), "base": own.column("base"),
        "start": pa.array((start + low[i]).astype(np.int32)), "stop": pa.array((stop + low[i]).astype(np.int32)),
        "source": other.column("node")})


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, unit, token)``, one per token of a unit."""
    for batch in batches:
        held = [np.unique(np.frombuffer(t.as_buffer(), np.uint32)) for t in batch.column(2)]
        at = pa.array(np.repeat(np.arange(len(held)), [len(t) for t in held]))
        token = np.concatenate([np.zeros(0, np.uint32), *held]).view(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(token)], names=["key", "unit", "token"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, unit, token)``, the tokens to look up for the open windows of a unit, from those it shares within its key."""
    for batch in batches:
        rare = []
        for opened, low, tokens, shared, df in zip(*(batch.column(c) for c in ("open", "low", "tokens", "shared", "df")), strict=True):
            x = np.frombuffer(tokens.as_buffer(), np.uint32)
            shared, df = np.array(shared.as_py(), np.int32).view(np.uint32), np.array(df.as_py(), np.int64)
            order = np.argsort(shared)
            at = order[np.minimum(np.searchsorted(shared, x, sorter=order), len(shared) - 1)]
            counts = np.where(shared[at] == x, df[at], 1)
            regions = _near_regions(np.sort(np.array(opened.as_py(), np.int64)) - low.as_py(), len(x))
            rare.append(np.unique(np.concatenate([x[a:b][_rare_places(counts[a:b], x[a:b].astype(np.int64))] for a, b in regions])))
        at = pa.array(np.repeat(np.arange(len(rare)), [len(t) for t in rare]))
        token = np.concatenate([np.zeros(0, np.uint32), *rare]).view(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("unit").take(at), pa.array(token)], names=["key", "unit", "token"])


def _by_token(hot: DataFrame) -> DataFrame:
    """``hot`` with a key for each token that a unit looks up: the units of its key that have it.

    Whoever shares a passage with a unit has one of its rare tokens, so no pair is lost. Only units that look the token up
    are open there. Rows are at most a unit's tokens; tokens of one text only, which are most, give none.
    """
    held = hot.select("key", "unit", "tokens").mapInArrow(_held, "key long, unit long, token int")
    shared = written(held.groupBy("key", "token").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    own = held.join(shared, ["key", "token"]).groupBy("key", "unit").agg(F.collect_list("token").alias("shared"), F.collect_list("df").alias("df"))
    opened = hot.where(F.size("open") > 0).select("key", "unit", "open", "low", "tokens").join(own, ["key", "unit"])
    asked = written(opened.mapInArrow(_asked, "key long, unit long, token int"), "asked")
    members = held.join(asked.select("key", "token").distinct(), ["key", "token"]).withColumn("asks", F.lit(False)).unionByName(
        asked.withColumn("asks", F.lit(True))).groupBy("key", "token", "unit").agg(F.max("asks").alias("asks"))
    return hot.join(written(members, "members"), ["key", "unit"]).withColumn(
        "open", F.when(F.col("asks"), F.col("open")).otherwise(F.array().cast("array<int>"))).withColumn(
        "key", F.concat_ws("-", "key", "token")).drop("asks", "token")


def _grouped(hoods: DataFrame, block: int) -> DataFrame:
    """Units to compare by ``key``: those of a key, or where they are more than a block, those of a key and a token."""
    sizes = written(hoods.groupBy("key").agg(F.count("*").alias("m")), "keys")
    hot = written(hoods.join(sizes.where(F.col("m") > block).select("key"), "key"), "hot", narrow=False)
    cold = hoods.join(sizes.where(F.col("m") <= block).select("key"), "key")
    return cold.withColumn("key", F.col("key").cast("string")).unionByName(_by_token(hot))


#: Units that a task of the last comparison gets, about. Each task leaves memory outside the heap of its executor, which
#: returns it late, so that there are no more tasks than large inputs need; small ones get a few per core, of two blocks at least.
_TASK_ROWS, _LEAST_ROWS, _TASKS_PER_CORE = 2048, 128, 4


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with a ``task`` for each pair of blocks of a key to compare, in about as many partitions as their number asks for.

    A key of one block is one task. Of larger ones, units with open windows meet all blocks, the others only those of open units.
    """
    asks = F.size("open") > 0 if "open" in rows.columns else F.lit(True)
    n_open, n_rest = F.count_if(asks), F.count_if(~asks)
    one = n_open + n_rest <= block
    sizes = written(rows.groupBy("key").agg(
        n_open.alias("a"), n_rest.alias("h"), F.when(one, 1).otherwise(F.ceil(n_open / block)).cast("int").alias("na"),
        F.when(one, 0).otherwise(F.ceil(n_rest / block)).cast("int").alias("nh")).where("a > 0"), "sizes")
    copies = sizes.agg(F.sum(F.expr("a * (na + nh) + h * na"))).first()[0] or 0
    opened, place = asks | (F.col("nh") == 0), F.xxhash64("unit")
    spread = rows.join(sizes.drop("a", "h"), "key").withColumn("i", F.when(opened, F.pmod(place, F.col("na"))).otherwise(
        F.col("na") + F.pmod(place, F.col("nh"))).cast("int"))
    others = F.sequence(F.lit(0), F.when(opened, F.col("na") + F.col("nh")).otherwise(F.col("na")) - 1)
    tasks = spread.withColumn("j", F.explode(others)).withColumn(
        "task", F.concat_ws("-", "key", F.least("i", "j"), F.greatest("i", "j"))).drop("j", "na", "nh")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return tasks.repartition(max(1, -(-copies // _TASK_ROWS), min(-(-copies // _LEAST_ROWS), _TASKS_PER_CORE * cores)), "task")


def passages(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, node, start_word, stop_word, first_doc_id)``: what each document repeats of an earlier one.

    Intervals of one document don't touch; ``stop_word`` is excluded. Words count from 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    noded = docs.select("doc_id", node_of(F.col("text")).alias("node"), "text")
    keyed = written(noded.mapInArrow(
        _keyed, f"doc_id {kind}, node binary, unit long, stop long, key array<bigint>, place array<int>"), "windows", narrow=False)
    spread = keyed.select("unit", F.inline(F.arrays_zip("key", "place")))
    # Sides of joins on hot keys are written, so that Spark can split those joins. Sides that grow with
    # the documents are merged at every size.
    several = written(spread.groupBy("key").agg(
        F.min("unit").alias("l"), F.max("unit").alias("h")).where("l <> h").select("key"), "several")
    company = written(spread.join(several.hint("merge"), "key").distinct(), "company")

    firsts = written(keyed.groupBy("node").agg(
        F.min("doc_id").alias("first"), (F.max("stop") + (SHINGLE - 1)).alias("n_words")), "firsts")
    owners = keyed.select("unit", "node").distinct().join(company.select("unit").distinct(), "unit").join(firsts, "node")
    owned = written(company.join(owners.select("unit", "node", "first"), "unit"), "owned")
    rank = F.struct(F.col("first").isNull(), "first", "node", "unit")
    leaders = written(owned.groupBy("key").agg(F.min(rank).alias("r")).select(
        "key", F.col("r.unit").alias("leader"), F.col("r.node").alias("leader_node"), F.col("r.first").alias("leader_first")), "leaders")
    led = written(owned.join(leaders, "key").where("node <> leader_node"), "led")
    met = led.select(row_key(F.col("first"), F.col("node")).alias("row_key")).union(
        led.select(row_key(F.col("leader_first"), F.col("leader_node")))).distinct()
    texts = noded.select(row_key(F.col("doc_id"), F.col("node")).alias("row_key"), "node", "text").join(
        met.hint("merge"), "row_key").dropDuplicates(["row_key"])
    needed = led.select("unit").union(led.select("leader")).distinct()
    contents = written(texts.select("row_key", "node", "text").mapInArrow(
        _contents, "node binary, unit long, base long, tokens binary").join(needed, "unit"), "contents", narrow=False)

    x = contents.select("unit", "node", "base", F.col("tokens").alias("x"))
    y = contents.select(F.col("unit").alias("leader"), F.col("node").alias("source"), F.col("tokens").alias("y"))
    pairs = led.select("unit", "leader").distinct().join(x, "unit").join(y, "leader").where("node <> source")
    found = written(pairs.select("unit", "leader", "node", "source", "base", "x", "y").mapInArrow(_pairs_verified, _FOUND), "found")

    # A row per unit, of one interval per start, so the join below has a row per window.
    longest = found.groupBy("unit", "node", "start").agg(F.max("stop").alias("stop"))
    covered = longest.groupBy("unit", "node").agg(F.collect_list(F.struct("start", "stop")).alias("covered"))
    inside = F.exists("covered", lambda c: (c["start"] <= F.col("place")) & (F.col("place") + RUN <= c["stop"]))
    marked = written(led.join(covered, ["unit", "node"], "left").withColumn(
        "open", ~F.coalesce(inside, F.lit(False))).drop("covered"), "marked")
    torn = written(marked.groupBy("key").agg(F.min("node").alias("l"), F.max("node").alias("h"), F.max("open").alias("o")).where(
        "l <> h AND o").select("key"), "torn")
    # A row per unit of a key, with the tokens around its places.
    low = F.greatest(F.array_min("places") - WIDE, F.lit(0))
    placed = marked.join(torn, "key").groupBy("key", "unit", "node", "first").agg(
        F.collect_set("place").alias("places"), F.collect_set(F.when(F.col("open"), F.col("place"))).alias("open")).withColumn("low", low)
    hoods = written(placed.join(contents.select("unit", "node", "base", "tokens"), ["unit", "node"]).withColumn(
        "tokens", F.substring("tokens", F.col("low") * 4 + 1, (F.array_max("places") + WIDE + 1 - F.col("low")) * 4)), "hoods", narrow=False)
    grouped = written(_grouped(hoods, block), "grouped", narrow=False)
    rest = written(_blocked(grouped, block).drop("key").groupBy("task").applyInArrow(_block_verified, _FOUND), "rest", narrow=False)

    words = found.unionByName(rest).join(
        firsts.select(F.col("node").alias("source"), F.col("first").alias("source_id")), "source").select(
        "node", (F.col("base") + F.col("start")).alias("start_word"),
        (F.col("base") + F.col("stop") + (SHINGLE - 1)).alias("stop_word"), "source_id").distinct()
    by_place = Window.partitionBy("node").orderBy("start_word", "stop_word")
    reach = F.max("stop_word").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start_word") <= F.col("reach"), 0).otherwise(1)).over(
        by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = words.withColumn("reach", reach).withColumn("island", island).groupBy("node", "island").agg(
        F.min("start_word").alias("start_word"), F.max("stop_word").alias("stop_word"), F.min("source_id").alias("first_doc_id"))
    own = firsts.join(merged, "node").select(
        F.col("first").alias("doc_id"), "node", "start_word", "stop_word", "first_doc_id")
    copies = (
        docs.select("doc_id", node_of(F.col("text")).alias("node")).distinct().join(firsts, "node")
        .where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .select("doc_id", "node", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("stop_word"),
                F.col("first").alias("first_doc_id")))
    return own.unionByName(copies)


_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def cut_words(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of ``spans`` and the signs after them."""
    if not text or not spans:
        return text
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    starts, _, _ = scan.spans(scan.LOWER[raw], np.array([0, len(raw)]), scan.LETTERS)
    edges = np.append(starts, len(data))
    out, at = [], 0
    for a, b in sorted(spans):
        low, high = int(edges[min(a, len(starts))]), int(edges[min(b, len(starts))])
        out.append(data[at : max(low, at)])
        at = max(at, high)
    return (b"".join(out) + data[at:]).decode()


def remove_passages(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``docs`` without the passages that an earlier document has; columns as they came.

    A text that has no word left goes with its document; ``n_chars``, where there is one, follows the text.
    """
    found = passages(docs, block)
    spans = found.groupBy(row_key(F.col("doc_id"), F.col("node")).alias("__key")).agg(
        F.collect_set(F.struct("start_word", "stop_word")).alias("__spans"))
    keyed = docs.withColumn("__key", row_key(F.col("doc_id"), node_of(F.col("text"))))
    # The window keeps the order that the join has made.
    once = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    marked = keyed.join(spans, "__key", "left").withColumn("__once", once).where("__once = 1")

    @F.udf("string", useArrow=True)
    def cut(text, spans):
        return cut_words(text, [(s["start_word"], s["stop_word"]) for s in spans or ()])

    touched = F.col("__spans").isNotNull()
    cleaned = marked.withColumn("text", F.when(touched, cut(F.when(touched, F.col("text")), "__spans")).otherwise(F.col("text")))
    left = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), _GAP), "")) > 0
    kept = cleaned.where(~touched | left)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(touched, n_chars).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)
