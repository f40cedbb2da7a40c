"""Community structure: components, label propagation, modularity; each graph by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Graph, graph_keys
from ..storage import Rounds, cut_lineage
from .edges import symmetrize
from .placed import PlacedEdges
from .skew import HOT_FLOOR, hot_keys, salt_copies, salt_rows

#: Votes are added as exact decimals, so they do not depend on row order; a weight below 5e-10 counts as 0.
_EXACT = "decimal(28,9)"


def _least_at(edges: DataFrame, end: str, keys: list[str], rounds: Rounds, hot_floor: int) -> DataFrame:
    """Each edge of a written table with ``least``: the smallest ``dst`` of the vertex at ``end``, null if it has none.

    The root of a large component is an end of nearly all its edges, so hot ends are split over several tasks.
    """
    lows = edges.groupBy(*keys, F.col("src").alias(end)).agg(F.min("dst").alias("least"))
    on = [*keys, end]
    hot = rounds.cut(hot_keys(edges, end, hot_floor))
    if not hot.isEmpty():
        edges, lows = salt_rows(edges, hot, end, F.struct("src", "dst")), salt_copies(lows, hot, end)
        on.append("salt")
    return edges.join(lows, on, "left")


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and a hash of all of them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*edges.columns))).first())


def connected_components(graph: Graph, max_rounds: int = 60, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """``(id, component)``: the smallest id of the vertex's weakly connected component.

    Alternates two contractions that hang every vertex below the smallest id
    it can see (Kiveris et al., 2014). The number of rounds grows with the
    logarithm of the graph's size, not with its diameter. Edges run from the
    larger to the smaller id, so what a vertex sees below itself are its own edges.
    """
    keys = graph_keys(graph.vertices)
    with Rounds() as rounds:
        edges = rounds.cut(graph.edges.where(F.col("src") != F.col("dst")).select(
            *keys, F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
        seen = _fingerprint(edges)
        for _ in range(max_rounds):
            below = _least_at(edges, "dst", keys, rounds, hot_floor)
            spread = rounds.cut(below.select(*keys, "src", F.coalesce("least", "dst").alias("dst")).distinct(), instead_of=edges)
            hung = _least_at(spread, "src", keys, rounds, hot_floor).select(*keys, F.inline(F.array(
                F.struct(F.col("dst").alias("src"), F.col("least").alias("dst")),
                F.struct(F.col("src"), F.col("least").alias("dst")),
            )))
            edges = rounds.cut(hung.where(F.col("src") != F.col("dst")).distinct(), instead_of=spread)
            now = _fingerprint(edges)
            if now == seen:
                roots = edges.select(*keys, F.col("src").alias("id"), F.col("dst").alias("component"))
                joined = graph.vertices.select(*keys, "id").join(roots, [*keys, "id"], "left")
                return cut_lineage(joined.select(*keys, "id", F.coalesce("component", "id").alias("component")))
            seen = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def _elected(votes: DataFrame, hot: DataFrame | None, keys: list[str]) -> DataFrame:
    """``(keys, id, chosen)``: the label with the most of ``votes(keys, id, label, vote)``, of equals the smallest.

    Votes are shuffled once, to their vertex, where they are added up and compared; few of them meet before. Those of a
    vertex in ``hot(src, fan)`` go to several tasks by label.
    """
    at = [*keys, "id"]
    if hot is not None:
        votes = salt_rows(votes, hot.withColumnRenamed("src", "id"), "id", F.col("label"))
        at = [*at, "salt"]
    counted = votes.repartition(*at).groupBy(*at, "label").agg(F.sum("vote").alias("votes"))
    best = counted.groupBy(*at).agg(F.min(F.struct((-F.col("votes")).alias("less"), "label")).alias("best"))
    if hot is not None:
        best = best.groupBy(*keys, "id").agg(F.min("best").alias("best"))
    return best.select(*keys, "id", F.col("best.label").alias("chosen"))


def label_propagation(
    graph: Graph, rounds: int = 5, weighted: bool = True, hot_floor: int = HOT_FLOOR
) -> DataFrame:
    """``(id, label)`` after synchronous rounds of neighbour votes.

    Every vertex takes the label with the largest total weight around it,
    ties to the smallest label; vertices without neighbours keep their own.
    """
    keys = graph_keys(graph.vertices)
    vote = F.col("weight").cast(_EXACT) if weighted else F.lit(1).cast(_EXACT)
    links = symmetrize(
        graph.edges.where(F.col("src") != F.col("dst")).select(*keys, "src", "dst", vote.alias("vote")))
    with Rounds() as held:
        placed = PlacedEdges(links, keys, held, hot_floor)
        labels = held.cut(graph.vertices.select(*keys, "id").withColumn("label", F.col("id")))
        for _ in range(rounds):
            chosen = _elected(placed.send(labels).select(*keys, F.col("dst").alias("id"), "label", "vote"), placed.hot, keys)
            # Written every round: labels are read twice by the next one.
            labels = held.cut(
                labels.join(chosen, [*keys, "id"], "left").select(*keys, "id", F.coalesce("chosen", "label").alias("label")),
                instead_of=labels)
        placed.release()
        return cut_lineage(labels)


def modularity(graph: Graph, labels: DataFrame) -> DataFrame:
    """``(modularity)`` of a division of the undirected weighted graph; one row per graph."""
    keys = graph_keys(graph.vertices)
    tagged = graph.edges.select(*keys, "src", "dst", "weight")
    for end in ("src", "dst"):
        named = labels.select(*keys, F.col("id").alias(end), F.col("label").alias(f"{end}_label"))
        tagged = tagged.join(named, [*keys, end])
    inside = F.when(F.col("src_label") == F.col("dst_label"), F.col("weight")).otherwise(F.lit(0.0))
    shares = tagged.select(*keys, F.inline(F.array(
        F.struct(F.col("src_label").alias("label"), F.col("weight").alias("degree"), inside.alias("inside")),
        F.struct(F.col("dst_label").alias("label"), F.col("weight").alias("degree"), F.lit(0.0).alias("inside")),
    )))
    groups = shares.groupBy(*keys, "label").agg(F.sum("degree").alias("degree"), F.sum("inside").alias("inside"))
    # Degrees count every edge twice, so their sum is twice the total weight.
    total = F.sum("degree")
    score = F.try_divide(F.sum("inside"), total / 2) - F.try_divide(F.sum(F.col("degree") * F.col("degree")), total * total)
    return groups.groupBy(*keys).agg(score.alias("modularity")) if keys else groups.agg(score.alias("modularity"))
