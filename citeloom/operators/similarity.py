"""All pairs of papers with cosine similarity above a threshold, exactly.

No pair becomes a row before it has passed the threshold. Each graph's
papers are dealt into tiles of bounded bytes; a task gets two tiles, multiplies
them as matrices and returns only the pairs that pass. A graph of any size
therefore spreads over many equal tasks, and no task holds more than two tiles.
Tiles hold papers of similar direction, and two tiles that are too far apart for
the threshold never meet (see ``tiles``).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import graph_keys
from ..storage import Rounds, cut_lineage
from .edges import symmetrize
from .tiles import deal, padded, routed, usable_papers

#: Bytes of vectors per tile. Papers are copied once for each tile of their graph, so few large tiles shuffle least.
TILE_BYTES = 16 << 20
#: Scores held at once; bounds the score matrix.
_SCORES = 4 << 20
#: Scores this close to the threshold are summed again in element order.
_DOUBT = 1e-9


def _ordered_dots(matrix: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products added up in element order, as the native expression does."""
    total = np.zeros(len(left))
    for k in range(matrix.shape[1]):
        total += matrix[left, k] * matrix[right, k]
    return total


def _passing(
    matrix: np.ndarray, norms: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and cosines of the pairs ``left`` x ``right`` that reach the threshold."""
    with np.errstate(all="ignore"):
        scale = np.outer(norms[left], norms[right])
        scores = np.where(scale > 0, (matrix[left] @ matrix[right].T) / scale, 0.0)
        # Spark orders NaN above every number, so a NaN score passes.
        keep = (scores >= threshold - _DOUBT) | np.isnan(scores)
        rows, columns = np.nonzero(keep)
        a, b, weight = left[rows], right[columns], scores[rows, columns]
        unsure = np.flatnonzero((np.abs(weight - threshold) <= _DOUBT) & (norms[a] > 0) & (norms[b] > 0))
        if len(unsure):
            again = _ordered_dots(matrix, a[unsure], b[unsure]) / (norms[a[unsure]] * norms[b[unsure]])
            weight[unsure] = again
        sure = (weight >= threshold) | np.isnan(weight)
    return a[sure], b[sure], weight[sure]


def _tile_scorer(keys: list[str], threshold: float) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("id").combine_chunks()
        ids = table["id"].combine_chunks()
        tile = table["tile"].to_numpy()
        first, second = table["tile_a"][0].as_py(), table["tile_b"][0].as_py()
        matrix = padded(table["vector"].combine_chunks())
        norms = table["norm"].to_numpy()
        left, right = np.flatnonzero(tile == first), np.flatnonzero(tile == second)
        rows = max(1, _SCORES // max(len(right), 1))
        for start in range(0, len(left), rows):
            strip = left[start:start + rows]
            # Row numbers follow the id order. Inside one tile only later rows are partners.
            partners = right[start:] if first == second else right
            a, b, weight = _passing(matrix, norms, strip, partners, threshold)
            if first == second:
                later = a < b
                a, b, weight = a[later], b[later], weight[later]
            columns = [pa.repeat(table[k][0], len(a)) for k in keys]
            columns += [ids.take(pa.array(np.minimum(a, b))), ids.take(pa.array(np.maximum(a, b))), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "src", "dst", "weight"])

    return score


# Ship this module's task code with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tile_pairs(vertices: DataFrame, min_similarity: float, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Every paper once per pair of tiles, which are dealt by a hash: all tiles of a graph meet."""
    keys = graph_keys(vertices)
    papers = usable_papers(vertices, min_similarity)
    held = F.sum(F.greatest(F.size("vector"), F.lit(0)).cast("long") * 8 + 64)
    tiles = F.greatest(F.ceil(held / tile_bytes), F.lit(1)).cast("int").alias("tiles")
    if keys:
        sized = papers.join(papers.groupBy(*keys).agg(tiles), keys)
    else:
        sized = papers.withColumn("tiles", F.coalesce(papers.agg(tiles).scalar(), F.lit(1)))
    routed = sized.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")).withColumn(
        "other_tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return routed.select(
        *keys, "id", "vector", "norm", "tile",
        F.least("tile", "other_tile").alias("tile_a"), F.greatest("tile", "other_tile").alias("tile_b"))


def similarity_pairs(
    vertices: DataFrame, min_similarity: float = 0.0, tile_bytes: int = TILE_BYTES, prune: bool = True
) -> DataFrame:
    """Pairs ``src < dst`` of one graph with ``weight >= min_similarity``.

    ``prune=False`` compares all tiles; that saves the pass that finds the papers' nearest centres,
    and the pairs are the same. The pruned result is a written table.
    """
    if not prune:
        return _scored(tile_pairs(vertices, min_similarity, tile_bytes), vertices, min_similarity)
    with Rounds() as held:
        return cut_lineage(_scored(routed(deal(vertices, min_similarity, tile_bytes, held)), vertices, min_similarity))


def _scored(dealt: DataFrame, vertices: DataFrame, min_similarity: float) -> DataFrame:
    keys = graph_keys(vertices)
    schema = T.StructType([
        *[vertices.schema[k] for k in keys],
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("weight", T.DoubleType()),
    ])
    return dealt.groupBy(*keys, "tile_a", "tile_b").applyInArrow(_tile_scorer(keys, float(min_similarity)), schema)


def similarity_edges(vertices: DataFrame, min_similarity: float = 0.0, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """The similar pairs as edges in both directions."""
    return symmetrize(similarity_pairs(vertices, min_similarity, tile_bytes))
