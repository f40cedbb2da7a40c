"""Tiles of vectors for an exact all-pairs join that skips what can't reach the threshold.

A graph's papers go to the nearest of some of its papers, the centres, about one for each ``tile_bytes`` of vectors. Such a cell has an
angular radius, the largest angle between a member and its centre. Two members of cells with centres at an angle
``t`` and radii ``r`` and ``s`` are at least ``t - r - s`` apart, so where that angle's cosine is below the threshold, no pair
of the two cells can pass and none is ever dealt to a task. All bounds hold with a margin for rounding, so the pairs that come out are
those of a join without pruning.

Cells above ``tile_bytes`` are split into tiles by a hash, and a task gets two tiles of two cells that may
hold a pair. Centres meet blocks of papers, and blocks of centres each other, in tasks of their own; no task holds a
graph's papers. Vectors without a sure direction (of zero, infinite or extreme length) form a cell that is near to all.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import norm
from ..schema import graph_keys
from ..storage import Rounds

#: Angles are trusted up to this, and lengths inside these bounds.
MARGIN = 1e-5
SHORT, LONG = 1e-100, 1e100
#: Cells whose centres are compared in one task come from two blocks of so many.
CELLS = 1024
_HASHES = 1 << 40


class Tiles(NamedTuple):
    """``papers(keys, id, vector, norm, wild, cell, angle)``, ``cells(keys, wild, cell, radius, n_tiles, n_papers)`` and
    ``near(keys, wild, cell, n_tiles, other_wild, other_cell, other_tiles)``, every pair of cells that may hold a pair, both ways.
    """

    keys: list[str]
    papers: DataFrame
    cells: DataFrame
    near: DataFrame


def padded(vectors: pa.Array) -> np.ndarray:
    """A list column as a zero-padded matrix; padding adds nothing to a dot product."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    values = pc.fill_null(vectors.flatten(), 0.0).to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _angles(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Between all rows of two matrices of unit vectors; the shorter ones count as padded."""
    width = min(left.shape[1], right.shape[1])
    return np.arccos(np.clip(left[:, :width] @ right[:, :width].T, -1.0, 1.0))


def _unit(vectors: pa.Array, norms: np.ndarray) -> np.ndarray:
    return padded(vectors) / norms[:, None]


def _nearest(keys: list[str]) -> Callable:
    """Papers of a block and all centres of its graph to papers with their cell and angle."""

    def run(table: pa.Table) -> pa.Table:
        centre = table["centre"].to_numpy()
        wild = table["wild"].to_numpy()
        papers = table.filter(pa.array(~centre)).combine_chunks()
        centres = table.filter(pa.array(centre)).sort_by("id").combine_chunks()
        tame = np.flatnonzero(~wild[~centre])
        cell, angle = np.full(papers.num_rows, -1), np.full(papers.num_rows, np.pi)
        if len(tame) and centres.num_rows:
            across = _unit(centres["vector"].combine_chunks(), centres["norm"].to_numpy())
            own = papers.take(pa.array(tame))
            units = _unit(own["vector"].combine_chunks(), own["norm"].to_numpy())
            strip = max(1, (4 << 20) // len(across))
            for start in range(0, len(units), strip):
                apart = _angles(units[start : start + strip], across)
                best = apart.argmin(1)
                at = tame[start : start + strip]
                cell[at], angle[at] = best, apart[np.arange(len(best)), best]
        names = centres["id"].combine_chunks().take(pa.array(cell, mask=cell < 0))
        return pa.table({**{k: papers[k] for k in [*keys, "id", "vector", "norm"]},
                         "wild": pa.array(cell < 0), "cell": names.fill_null(""), "angle": pa.array(angle)})

    return run


def _near_cells(keys: list[str], reach: float) -> Callable:
    """Two blocks of cells to the pairs of them that may hold a pair of papers, both ways."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        block, first, second = table["block"].to_numpy(), table["block_a"][0].as_py(), table["block_b"][0].as_py()
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        wild, radius = table["wild"].to_numpy(), table["radius"].to_numpy()
        units = padded(table["vector"].combine_chunks())
        length = np.sqrt((units * units).sum(1))
        units = units / np.where(length > 0, length, 1.0)[:, None]
        gap = _angles(units[left], units[right]) - radius[left][:, None] - radius[right][None, :]
        i, j = np.nonzero((gap <= reach) | wild[left][:, None] | wild[right][None, :])
        a, b = left[i], right[j]
        if first != second:
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
        own, other = table.take(pa.array(a)), table.take(pa.array(b))
        return pa.table({**{k: own[k] for k in [*keys, "wild", "cell", "n_tiles"]},
                         "other_wild": other["wild"], "other_cell": other["cell"], "other_tiles": other["n_tiles"]})

    return run


# Ship this module's task code with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _joined(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of a graph at its rows; without graph ids the facts are one row."""
    if keys:
        return rows.join(facts, keys)
    one = F.lit(1).alias("__one")
    return rows.select("*", one).join(F.broadcast(facts.select("*", one)), "__one").drop("__one")


def usable_papers(vertices: DataFrame, min_similarity: float) -> DataFrame:
    """``(keys, id, vector, norm)`` of the papers that can be in a pair; an unusable length counts as 0."""
    length = norm(F.col("vector"))
    usable = F.when((length > 0) & ~F.isnan(length), length)
    papers = vertices.where(F.col("id").isNotNull()).select(
        *graph_keys(vertices), "id", "vector", F.coalesce(usable, F.lit(0.0)).alias("norm"))
    return papers.where(F.col("norm") > 0) if min_similarity > 0 else papers


def deal(vertices: DataFrame, min_similarity: float, tile_bytes: int, held: Rounds) -> Tiles:
    """Papers by cells, and the cells that may hold pairs; what is written goes with ``held``."""
    keys = graph_keys(vertices)
    papers = usable_papers(vertices, min_similarity)
    wild = (F.col("norm") < SHORT) | (F.col("norm") > LONG)
    place = F.pmod(F.xxhash64("id"), F.lit(_HASHES))
    size = F.greatest(F.size("vector"), F.lit(0)).cast("long") * 8 + 64
    tiles = F.ceil(F.sum(size) / tile_bytes)
    facts = papers.groupBy(*keys).agg(
        F.greatest(tiles, F.lit(1)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"),
        F.min(F.when(~wild, F.struct(place.alias("place"), F.col("id")))).alias("least"))
    known = _joined(papers.withColumn("wild", wild), facts, keys)
    share = (F.col("blocks") - 1) / F.col("n") * _HASHES
    chosen = known.where(~F.col("wild") & ((F.col("id") == F.col("least.id")) | (place < share)))
    columns = [*keys, "id", "vector", "norm", "wild"]
    centres = held.cut(chosen.select(*columns, "blocks").dropDuplicates([*keys, "id"]))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int").alias("block")
    copies = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    met = known.select(*columns, F.lit(False).alias("centre"), block).unionByName(
        centres.select(*columns, F.lit(True).alias("centre"), copies))
    kinds = {f.name: f.dataType.simpleString() for f in papers.schema}
    prefix = "".join(f"{k} {kinds[k]}, " for k in keys)
    assigned = held.cut(met.groupBy(*keys, "block").applyInArrow(
        _nearest(keys), f"{prefix}id string, vector {kinds['vector']}, norm double, wild boolean, cell string, angle double"))
    cells = assigned.groupBy(*keys, "wild", "cell").agg(
        F.max("angle").alias("radius"), F.ceil(F.sum(size) / tile_bytes).cast("int").alias("n_tiles"), F.count(F.lit(1)).alias("n_papers"))
    named = centres.select(*keys, F.col("id").alias("cell"), F.lit(False).alias("wild"), "vector")
    cells = cells.join(named, [*keys, "wild", "cell"], "left")
    blocks = cells.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / CELLS).cast("int").alias("blocks"))
    dealt = _joined(cells, blocks, keys).withColumn("block", F.pmod(F.xxhash64("cell"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other")).drop("other", "blocks")
    reach = float(np.arccos(np.clip(min_similarity, -1.0, 1.0))) + MARGIN
    near = dealt.groupBy(*keys, "block_a", "block_b").applyInArrow(
        _near_cells(keys, reach),
        f"{prefix}wild boolean, cell string, n_tiles int, other_wild boolean, other_cell string, other_tiles int")
    return Tiles(keys, assigned, cells.drop("vector"), near)


def _tile(wild: str, cell: str, number: Column) -> Column:
    return F.concat_ws("|", F.col(wild).cast("string"), number.cast("string"), cell)


def routed(tiles: Tiles) -> DataFrame:
    """``(keys, id, vector, norm, tile, tile_a, tile_b)``: every paper once per pair of tiles it takes part in."""
    at = [*tiles.keys, "wild", "cell"]
    own = _tile("wild", "cell", F.pmod(F.xxhash64("id"), F.col("n_tiles")))
    met = tiles.papers.join(tiles.near, at).withColumn("tile", own).withColumn(
        "number", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)))
    other = _tile("other_wild", "other_cell", F.col("number"))
    return met.select(*tiles.keys, "id", "vector", "norm", "tile",
                      F.least(F.col("tile"), other).alias("tile_a"), F.greatest(F.col("tile"), other).alias("tile_b"))


def routing_report(tiles: Tiles) -> DataFrame:
    """``(keys, papers, tiles, tile_pairs, tile_pairs_kept, copies, copies_kept)``: what the bounds save, by graph."""
    keys = tiles.keys
    total = tiles.cells.groupBy(*keys).agg(F.sum("n_papers").alias("papers"), F.sum("n_tiles").alias("tiles"))
    same = (F.col("wild") == F.col("other_wild")) & (F.col("cell") == F.col("other_cell"))
    pairs = F.sum(F.when(same, F.col("n_tiles") * (F.col("n_tiles") + 1)).otherwise(F.col("n_tiles") * F.col("other_tiles")))
    copies = F.sum(F.col("n_papers") * F.col("other_tiles"))
    kept = tiles.near.join(tiles.cells.select(*keys, "wild", "cell", "n_papers"), [*keys, "wild", "cell"]).groupBy(*keys).agg(
        (pairs / 2).cast("long").alias("tile_pairs_kept"), copies.alias("copies_kept"))
    return _joined(total, kept, keys).select(
        *keys, "papers", "tiles", (F.col("tiles") * (F.col("tiles") + 1) / 2).cast("long").alias("tile_pairs"),
        "tile_pairs_kept", (F.col("papers") * F.col("tiles")).alias("copies"), "copies_kept")
