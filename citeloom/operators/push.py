"""PageRank by pushing changes: only vertices with enough left to pass on send messages.

A vertex holds a rank and a residual, what has come in but has not been passed on. A round takes the residuals above the
tolerance into the ranks and sends each along its vertex's edges; the others wait. The ranks and residuals
together always satisfy the equations of :func:`citeloom.operators.rank.pagerank` with ``normalize``, run to the end: what is missing in all
ranks together is at most the sum of what is left, divided by ``reset_prob``.

**Going on after changes.** The state of an earlier run and its graph are enough for a run on a changed graph: sources whose edges
changed take back what they sent along the old ones and send it along the new ones, new vertices start with their
reset, and only what follows from that is pushed on.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Graph, graph_keys
from ..storage import Rounds, cut_lineage, release
from .placed import PlacedEdges
from .rank import RESET_PROB

TOLERANCE = 1e-6
MAX_ROUNDS = 500


class Pushed(NamedTuple):
    """``state(keys, id, rank, residual)`` of a run, and the number of messages of each of its rounds."""

    state: DataFrame
    messages: list[int]


def _shares(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, src, dst, share)``: the part of a source's rank that an edge carries; repeats are added up."""
    totals = edges.groupBy(*keys, "src").agg(F.sum("weight").alias("total"))
    summed = edges.groupBy(*keys, "src", "dst").agg(F.sum("weight").alias("weight"))
    return summed.join(totals, [*keys, "src"]).select(*keys, "src", "dst", F.try_divide("weight", "total").alias("share")).where(
        "share IS NOT NULL AND share <> 0")


def push_pagerank(
    graph: Graph,
    reset_prob: float = RESET_PROB,
    tolerance: float = TOLERANCE,
    max_rounds: int = MAX_ROUNDS,
    before: tuple[DataFrame, Graph] | None = None,
) -> Pushed:
    """Ranks of the normalised form, to a tolerance per vertex; weights must not be negative.

    ``before`` is the state of an earlier run and the graph it ran on. The state is written to the shared folder.
    """
    keys = graph_keys(graph.vertices)
    on = [*keys, "id"]
    with Rounds() as held:
        edges = graph.edges.select(*keys, "src", "dst", "weight")
        if not edges.where("weight < 0").isEmpty():
            raise ValueError("negative weights")
        shares = _shares(edges, keys)
        if before is not None:
            shares = held.cut(shares)
        # Laid out by source once: a round shuffles what it sends, not the edges.
        placed = PlacedEdges(shares, keys, held)
        ids = graph.vertices.where("id IS NOT NULL").select(*on).distinct()
        fresh = ids.withColumn("rank", F.lit(0.0)).withColumn("residual", F.lit(reset_prob))
        messages: list[int] = []
        if before is None:
            state = held.cut(fresh)
        else:
            state = held.cut(_carried(ids, before, shares, keys, reset_prob, messages))
        for _ in range(max_rounds):
            active = state.where(F.abs("residual") > tolerance)
            sent = placed.send(active.select(*on, "residual"))
            inflow = sent.groupBy(*keys, F.col("dst").alias("id")).agg(
                F.sum(F.col("residual") * F.col("share") * (1 - reset_prob)).alias("inflow"), F.count(F.lit(1)).alias("n"))
            taken = F.when(F.abs("residual") > tolerance, F.col("residual")).otherwise(0.0)
            last, state = state, held.cut(state.select(*on, "rank", "residual").join(inflow, on, "left").select(
                *on, (F.col("rank") + taken).alias("rank"),
                (F.col("residual") - taken + F.coalesce("inflow", F.lit(0.0))).alias("residual"), F.coalesce("n", F.lit(0)).alias("n")))
            release(last)
            facts = state.agg(F.sum("n").alias("n"), F.max(F.abs("residual")).alias("most")).first()
            messages.append(facts.n or 0)
            if (facts.most or 0.0) <= tolerance:
                settled = cut_lineage(state.select(*on, "rank", "residual"))
                placed.release()
                return Pushed(settled, messages)
        placed.release()
    raise RuntimeError(f"ranks not settled after {max_rounds} rounds")


def _carried(
    ids: DataFrame, before: tuple[DataFrame, Graph], shares: DataFrame, keys: list[str], reset_prob: float, messages: list[int]
) -> DataFrame:
    """The state on the changed graph: old ranks, and residuals corrected where edges or vertices changed."""
    old_state, old_graph = before
    on, link = [*keys, "id"], [*keys, "src", "dst"]
    old = _shares(old_graph.edges.select(*keys, "src", "dst", "weight"), keys)
    # Vertices that are gone send nothing any more.
    kept = old_state.select(*on, "rank", "residual")
    both = old.select(*link, (-F.col("share")).alias("share")).unionByName(shares).groupBy(*link).agg(F.sum("share").alias("share"))
    changed = both.where(F.abs("share") > 1e-15)
    sent = changed.join(kept.select(*keys, F.col("id").alias("src"), "rank"), [*keys, "src"])
    inflow = sent.groupBy(*keys, F.col("dst").alias("id")).agg(
        F.sum(F.col("rank") * F.col("share") * (1 - reset_prob)).alias("inflow"), F.count(F.lit(1)).alias("n"))
    met = ids.join(kept, on, "left").join(inflow, on, "left")
    state = met.select(
        *on, F.coalesce("rank", F.lit(0.0)).alias("rank"),
        (F.coalesce("residual", F.lit(reset_prob)) + F.coalesce("inflow", F.lit(0.0))).alias("residual"), F.coalesce("n", F.lit(0)).alias("n"))
    messages.append(inflow.agg(F.sum("n")).first()[0] or 0)
    return state
