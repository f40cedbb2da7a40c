"""MinHash near-dedup with DartMinHash signatures.

A document is a weighted set: its shingles of five words (A–Z lower-cased, words of
letters, digits and non-ASCII characters) weighted by how often they occur, a text of
fewer words is one shingle. An element of weight ``w`` owns the region ``[0, w)`` times
all ranks. Darts fall on it as a Poisson process driven by hashes of element, weight
cell and dart number only, so two sets that share a part of a region share its darts. Each
dart also hits one of ``k`` coordinates; of all darts of a set the earliest of each
coordinate is kept. The signature of a set of total weight ``W`` needs about
``k ln k + 2k`` darts, so only ranks below ``(k ln k + 2k) / W`` are thrown, and doubled
for the few sets with a coordinate left open. Two signatures agree in a coordinate with the
weighted Jaccard similarity.

Signatures are cut into bands. Sets of one band value are candidates; every link that
counts is verified by the exact weighted Jaccard similarity of the whole texts.

Hot groups. Equal texts are one node from the start. In a band value, every node is
first compared with one leader, the node with most company, which is a linear number of
pairs. Where nodes of a band value that aren't leaders are still in different
components, they are compared with each other in blocks of 256 nodes inside tasks,
that return at most a spanning forest. So no pairs of a group are laid out as rows, no
group is held by one task, and no candidate is left out.

Defined cases: null counts as the empty text; texts without words match equal texts only;
a repeated row is in the class of its text; classes are named by their smallest ``doc_id``,
null if all are null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import scan
from citeloom.llm.graphs import components, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
BLOCK = 256

_SEEDS = [int(x) for x in scan.mix(np.arange(1, 5, dtype=np.uint64))]


def weighted_cells(column: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(cell, row)``: a unit of weight each, that is a shingle and its occurrence; sorted by row and cell."""
    data, offsets = scan.text_bytes(column)
    data = scan.LOWER[data]
    starts, ends, row = scan.spans(data, offsets, scan.LETTERS)
    made, owner = scan.shingles(scan.hashes(data, starts, ends), row, len(offsets) - 1, width)
    order = np.lexsort((made, owner))
    made, owner = made[order], owner[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    nth = np.arange(len(made)) - np.repeat(begins, np.diff(np.append(begins, len(made))))
    again = nth > 0
    made[again] = scan.mix(made[again] + nth[again].astype(np.uint64) * np.uint64(_SEEDS[0]))
    order = np.lexsort((made, owner))
    return made[order], owner[order]


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(cells: np.ndarray, row: np.ndarray, n_rows: int, k: int,
               part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(signature, has)``: ``n_rows`` by ``k`` dart names; ``has`` is false for rows without cells.

    ``part`` gives the share of each cell that is owned (1 if absent), for real weights.
    """
    sizes = np.bincount(row, part, n_rows) if part is not None else np.bincount(row, minlength=n_rows).astype(np.float64)
    out = np.zeros((n_rows, k), np.uint64)
    open_rows = sizes > 0
    reach = np.where(open_rows, (k * math.log(k) + 2 * k) / np.maximum(sizes, 1e-9), 0.0)
    while open_rows.any():
        chosen = np.flatnonzero(open_rows[row])
        own, at, share = cells[chosen], row[chosen], None if part is None else part[chosen]
        ranks = np.full(n_rows * k, np.inf)
        thrown = []
        rank = np.zeros(len(own))
        number = 0
        while len(own):
            h = scan.mix(own + np.uint64((_SEEDS[1] + number * _SEEDS[2]) & ((1 << 64) - 1)))
            rank = rank - np.log(_uniform(h))
            left = rank < reach[at]
            own, at, rank, h = own[left], at[left], rank[left], h[left]
            share = share if share is None else share[left]
            dart = scan.mix(h + np.uint64(_SEEDS[3]))
            hit = np.ones(len(own), bool) if share is None else _uniform(scan.mix(dart + np.uint64(1))) < share
            place = at[hit] * k + (dart[hit] % np.uint64(k)).astype(np.int64)
            np.minimum.at(ranks, place, rank[hit])
            thrown.append((place, rank[hit], dart[hit]))
            number += 1
        flat = out.reshape(-1)
        for place, r, dart in thrown:
            first = r == ranks[place]
            flat[place[first]] = dart[first]
        filled = np.isfinite(ranks).reshape(n_rows, k).all(1)
        open_rows &= ~filled
        reach = reach * 2
    return out, sizes > 0


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``bands`` 64-bit values per signature, different between bands."""
    total = np.repeat(scan.mix(np.arange(1, bands + 1, dtype=np.uint64))[None, :], len(signature), 0)
    for r in range(rows):
        total = scan.mix(total + signature[:, r : bands * rows : rows])
    return total


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def row_key(doc_id: Column, node: Column) -> Column:
    """One name for a document, that is an id and a text."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.hex(node)))


def _banded(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, "text"):
                signature, has = signatures(*weighted_cells(part.column(2)), part.num_rows, bands * rows)
                values = band_values(signature[has], bands, rows).astype(np.int64).reshape(-1)
                ends = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["doc_id", "node", "bands"])

    return run


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch, "text"):
            cells, row = weighted_cells(part.column(1))
            ends = np.cumsum(np.bincount(row, minlength=part.num_rows)) * 8
            offsets = np.concatenate([[0], ends]).astype(np.int64)
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(cells.tobytes())])
            yield pa.RecordBatch.from_arrays([part.column(0), packed.cast(pa.binary())], names=["node", "cells"])


def _verified(threshold: float):
    """Pairs with the cells of both sides to the pairs that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                small, large = sorted((len(x), len(y)))
                if small < threshold * large:
                    near.append(False)
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                near.append(shared >= threshold * (small + large - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def forest(cells: list[np.ndarray], roots: list[bytes], threshold: float) -> list[tuple[int, int]]:
    """Links between members of different components that reach the threshold; at most a spanning forest."""
    sizes = np.array([len(c) for c in cells])
    every, column = np.unique(np.concatenate(cells), return_inverse=True)
    owner = np.repeat(np.arange(len(cells)), sizes)
    common = np.bincount(column, minlength=len(every)) > 1
    number = np.cumsum(common) - 1
    keep = common[column]
    column, owner = number[column[keep]], owner[keep]
    shared = np.zeros((len(cells), len(cells)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    step = 4096
    for low in range(0, int(common.sum()), step):
        a, b = np.searchsorted(column, (low, low + step))
        dense = np.zeros((len(cells), step), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        shared += dense @ dense.T
    near = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-6
    parent: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        a, b = top(roots[i]), top(roots[j])
        if a != b:
            parent[a] = b
            out.append((int(i), int(j)))
    return out


def _in_blocks(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        nodes, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
        cells = [np.frombuffer(c.as_buffer(), np.uint64) for c in table.column("cells")]
        links = forest(cells, roots, threshold)
        return pa.table({"a": pa.array([nodes[i] for i, _ in links], pa.binary()), "b": pa.array([nodes[j] for _, j in links], pa.binary())})

    return run


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """``rows(band, node, root)`` with a ``task``: all pairs of blocks of a band value."""
    sizes = rows.groupBy("band").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    spread = rows.join(sizes, "band").withColumn("i", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    other = spread.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return other.select("node", "root", F.concat_ws(
        "-", "band", F.least("i", "j"), F.greatest("i", "j")).alias("task"))


def _classes(docs: DataFrame, threshold: float, bands: int, rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, node)`` of all rows, and ``(node, class_id, class_node)`` of all texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    noded = docs.select("doc_id", node_of(F.col("text")).alias("node"), "text")
    sketched = written(noded.mapInArrow(_banded(bands, rows), f"doc_id {kind}, node binary, bands array<bigint>"), "sketch", narrow=False)
    firsts = written(sketched.groupBy("node").agg(F.min("doc_id").alias("first")), "firsts")
    spread = sketched.select("node", F.explode("bands").alias("band"))
    # Sides of joins on hot keys are written, so that Spark can split those joins. Sides that grow with
    # the documents are merged at every size.
    several = written(spread.groupBy("band").agg(
        F.min("node").alias("l"), F.max("node").alias("h"), F.count("*").alias("n")).where("l <> h").select("band", "n"), "several")
    company = written(spread.join(several.hint("merge"), "band").distinct(), "company")
    popular = company.groupBy("node").agg(F.sum("n").alias("weight"))
    placed = company.join(popular, "node").select("band", "node", "weight")
    leaders = written(placed.groupBy("band").agg(F.max(F.struct("weight", "node"))["node"].alias("leader")), "leaders")
    led = written(company.select("band", "node").join(leaders, "band").where("node <> leader"), "led")
    pairs = led.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()

    met = company.select("node").distinct().join(firsts, "node").select(row_key(F.col("first"), F.col("node")).alias("row_key"))
    texts = noded.select(row_key(F.col("doc_id"), F.col("node")).alias("row_key"), "node", "text").join(
        met.hint("merge"), "row_key").dropDuplicates(["row_key"])
    cells = written(texts.select("node", "text").mapInArrow(_cells_of, "node binary, cells binary"), "cells", narrow=False)
    sides = [cells.select(F.col("node").alias(s), F.col("cells").alias(f"c{s}")) for s in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "ca", "cb")
    links = written(joined.mapInArrow(_verified(threshold), "a binary, b binary"), "links")

    roots = written(components(links), "roots")
    rooted = led.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    torn = rooted.groupBy("band").agg(F.min("root").alias("l"), F.max("root").alias("h")).where("l <> h").select("band")
    tasks = _blocked(rooted.join(torn, "band"), block).join(cells, "node")
    rest = written(tasks.groupBy("task").applyInArrow(_in_blocks(threshold), "a binary, b binary"), "rest")
    if rest.limit(1).count():
        linked = links.unionByName(rest)
        roots = written(components(linked), "roots")

    named = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("head"))
    classes = named.join(heads, "root").select("node", F.col("head.first").alias("class_id"), F.col("head.node").alias("class_node"))
    return sketched.select("doc_id", "node"), classes


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                 block: int = BLOCK) -> DataFrame:
    """``(doc_id, node, class_id, class_node)``, one row per row of ``docs``.

    ``node`` names the text; ``class_id`` and ``class_node`` name the class by its first document.
    """
    documents, classes = _classes(docs, threshold, bands, rows, block)
    return documents.join(written(classes, "classes"), "node").select("doc_id", "node", "class_id", "class_node")


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the smallest id; columns as they came."""
    _, classes = _classes(docs, threshold, BANDS, ROWS, BLOCK)
    kept = classes.select(row_key(F.col("class_id"), F.col("class_node")).alias("__key")).distinct()
    # The window keeps the order that the join has made; it takes one of rows of equal id and text.
    once = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    keyed = docs.withColumn("__key", row_key(F.col("doc_id"), node_of(F.col("text"))))
    return keyed.join(kept, "__key", "left_semi").withColumn("__once", once).where("__once = 1").select(*docs.columns)
