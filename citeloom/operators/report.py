"""Rank reports, display tables and graph counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import display
from ..schema import Graph, graph_keys


def top_ranked(ranks: DataFrame, k: int = display.TOP_NODES) -> DataFrame:
    """The ``k`` best vertices of each graph with their ``position``, ties by id."""
    keys = graph_keys(ranks)
    order = [F.desc("rank"), F.asc("id")]
    if keys:
        # The planner filters on the map side: each task sends k rows per graph.
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return ranks.withColumn("position", place).where(F.col("position") <= k)
    best = ranks.orderBy(*order).limit(k)
    return best.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def viz_nodes(ranks: DataFrame, blank: str = " ", with_venue: bool = False, top: int = display.TOP_NODES) -> DataFrame:
    """Display rows of all vertices: label, hover text, fixed size, size by rank.

    ``ranks`` carries the vertex attributes already, so only the few top
    vertices are joined back.
    """
    keys = graph_keys(ranks)
    best = top_ranked(ranks, top).select(*keys, "id", F.lit(True).alias("is_top"), F.col("rank").alias("top_rank"))
    if keys:
        flagged = ranks.join(best.drop("top_rank"), [*keys, "id"], "left")
        peak = best.groupBy(*keys).agg(F.max("top_rank").alias("peak"))
        flagged = flagged.join(peak, keys)
    else:
        # ``top`` rows, whatever the size of the graph.
        flagged = ranks.join(F.broadcast(best.drop("top_rank")), "id", "left")
        flagged = flagged.withColumn("peak", best.agg(F.max("top_rank")).scalar())
    is_top = F.coalesce("is_top", F.lit(False))
    hover = [F.col("title"), F.col("venue"), F.col("year")] if with_venue else [F.col("title")]
    scaled = F.when(F.col("peak") > 0, F.greatest(F.col("rank"), F.lit(0.0)) / F.col("peak") * display.TOP_SIZE)
    return flagged.select(
        *keys,
        "id",
        display.node_label(is_top, F.col("title"), blank).alias("label"),
        display.tooltip(*hover).alias("hover"),
        display.node_size(is_top).alias("size"),
        F.coalesce(scaled, F.lit(0.0)).alias("size_scaled"),
    )


def viz_edges(
    edges: DataFrame, scale: float = display.EDGE_SCALE, floor: float = display.EDGE_FLOOR
) -> DataFrame:
    """Display rows of all edges; fallback links are black and without arrow."""
    plain = F.lit(None).cast("string")
    fallback = F.col("edge_type") == "fallback" if "edge_type" in edges.columns else F.lit(False)
    return edges.select(
        *graph_keys(edges),
        "src",
        "dst",
        display.thickness(F.col("weight"), scale, floor).alias("value"),
        display.weight_label(F.col("weight")).alias("label"),
        F.when(fallback, F.lit("black")).otherwise(plain).alias("color"),
        F.when(fallback, F.lit("")).otherwise(plain).alias("arrows"),
    )


def graph_stats(graph: Graph) -> DataFrame:
    """Vertices, candidate pairs and edges per graph; pairs are counted, not built."""
    keys = graph_keys(graph.vertices)
    marks = graph.vertices.select(*keys, F.lit(1).alias("v"), F.lit(0).alias("e")).unionByName(
        graph.edges.select(*keys, F.lit(0).alias("v"), F.lit(1).alias("e")))
    counted = marks.groupBy(*keys).agg(F.sum("v").alias("n_vertices"), F.sum("e").alias("n_edges"))
    # One of n and n - 1 is even, so halving the product is exact.
    pairs = F.col("n_vertices") * (F.col("n_vertices") - 1) / 2
    return counted.select(*keys, "n_vertices", pairs.cast("long").alias("n_pairs"), "n_edges")
