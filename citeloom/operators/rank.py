"""Weighted PageRank over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Graph, graph_keys
from ..storage import Rounds, cut_lineage
from .placed import PlacedEdges, WrittenEdges, place
from .skew import HOT_FLOOR

# The ranking's default parameters.
RESET_PROB = 0.15
MAX_ITER = 10

_ATTRIBUTES = ("title", "venue", "year")


def _out_normalized(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Weights divided by the source's total weight."""
    totals = edges.groupBy(*keys, "src").agg(F.sum("weight").alias("total"))
    joined = edges.join(totals, [*keys, "src"])
    return joined.withColumn("weight", F.try_divide("weight", "total")).drop("total")


def _roles(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, id, n, sends, gets)``: how often a vertex is listed, and whether it is a source and a target of edges."""
    ends = edges.select(*keys, F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.lit(True).alias("sends"), F.lit(False).alias("gets")),
        F.struct(F.col("dst").alias("id"), F.lit(False).alias("sends"), F.lit(True).alias("gets")),
    ))).groupBy(*keys, "id").agg(F.max("sends").alias("sends"), F.max("gets").alias("gets"))
    listed = nodes.groupBy(*keys, "id").agg(F.count(F.lit(1)).alias("n"))
    no = F.lit(False)
    return listed.join(ends, [*keys, "id"], "left").select(
        *keys, "id", "n", F.coalesce("sends", no).alias("sends"), F.coalesce("gets", no).alias("gets"))


def _inflow(sent: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, id, inflow)``: what arrives at each target."""
    return sent.groupBy(*keys, F.col("dst").alias("id")).agg(
        F.sum(F.col("n") * F.col("rank") * F.col("weight")).alias("inflow"))


def pagerank(
    graph: Graph,
    reset_prob: float = RESET_PROB,
    max_iter: int = MAX_ITER,
    normalize: bool = False,
    checkpoint_every: int = 5,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """``(id, rank, title[, venue, year])`` after ``max_iter`` rounds.

    A round sets ``rank = reset_prob + (1 - reset_prob) * sum(rank * weight)``
    over the incoming edges, starting from 1. Weights are used as they are
    unless ``normalize`` is set, so ranks may grow or become negative.

    The rounds run on the vertices that both send and receive, laid out once
    with the edges among them. A vertex that only sends holds ``reset_prob`` from
    the first round on, so its part is summed once; one that only receives
    needs the last round alone, which goes over all edges. A round shuffles
    only the sums per target, which are combined before the shuffle; an often-cited
    paper costs one row per task. The result is written to the shared folder.
    """
    keys = graph_keys(graph.vertices)
    attributes = [c for c in _ATTRIBUTES if c in graph.vertices.columns]
    edges = graph.edges.select(*keys, "src", "dst", "weight")
    if normalize:
        edges = _out_normalized(edges, keys)
    nodes = graph.vertices.select(*keys, "id", *attributes)
    if max_iter == 0:
        return nodes.select(*keys, "id", F.lit(1.0).alias("rank"), *attributes)
    on = [*keys, "id"]
    with Rounds() as rounds:
        whole = WrittenEdges(edges, keys, rounds, hot_floor)
        roles = rounds.cut(_roles(nodes, whole.written, keys))
        core, givers = roles.where("sends AND gets"), roles.where("sends AND NOT gets")
        inward = rounds.cut(whole.written.join(core.select(*keys, F.col("id").alias("dst")), [*keys, "dst"], "left_semi"))
        placed = PlacedEdges(
            inward.join(core.select(*keys, F.col("id").alias("src")), [*keys, "src"], "left_semi"), keys, rounds, hot_floor)
        steady = rounds.cut(inward.join(givers.select(*keys, F.col("id").alias("src"), "n"), [*keys, "src"]).groupBy(
            *keys, F.col("dst").alias("id")).agg(F.sum(F.col("n") * F.col("weight")).alias("steady")), instead_of=inward)
        movers = place(core.join(steady, on, "left").select(*on, "n", "steady"), on, placed.parts)

        ranks = movers.select(*on, "n", F.lit(1.0).alias("rank"))
        for done in range(1, max_iter):
            given = F.lit(1.0 if done == 1 else reset_prob) * F.coalesce("steady", F.lit(0.0))
            received = F.coalesce("inflow", F.lit(0.0)) + given
            ranks = movers.join(_inflow(placed.send(ranks), keys), on, "left").select(
                *on, "n", (F.lit(reset_prob) + F.lit(1 - reset_prob) * received).alias("rank"))
            if done % checkpoint_every == 0:
                ranks = rounds.cut(ranks)

        held = givers.select(*on, "n", F.lit(1.0 if max_iter == 1 else reset_prob).alias("rank"))
        inflow = _inflow(whole.send(rounds.cut(ranks.unionByName(held))), keys)
        received = F.coalesce("inflow", F.lit(0.0))
        last = roles.join(inflow, on, "left").select(
            *on, F.explode(F.array_repeat(F.lit(reset_prob) + F.lit(1 - reset_prob) * received, F.col("n").cast("int"))).alias("rank"))
        result = cut_lineage(nodes.join(last, on).select(*on, "rank", *attributes))
        movers.unpersist()
        placed.release()
    return result
