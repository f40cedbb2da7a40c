"""Communities of high modularity: local moving and contraction, each graph by itself.

Every vertex starts as its own community. In a half-round the vertices of one half, a new one each time, look at the communities
around them at once: moving vertex ``i`` to ``c`` is worth ``w(i, c) - k(i) K(c) / 2m``, with the weight ``w`` of its links into ``c``, its
degree ``k``, the degrees ``K`` of the others in ``c`` and the total weight ``m``. Each takes the best place, its own if none is better.
Moves that are good one by one can be bad together, so the modularity is taken after each half-round, and a graph that has
lost by it goes back and tries a smaller share of its vertices next; it never falls. When no vertex gains any more, communities become
the vertices of a smaller graph, with their links added up, and all starts again, until contraction brings nothing.

Links are undirected: directions and repeats are added up, weights that aren't positive are left out. Weights count as
exact decimals of nine places, so sums don't depend on the order of rows. Joins are plain equi-joins on written
tables, so Spark splits hubs; a round exchanges links once per end and sums per vertex and community.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import Graph, graph_keys
from ..storage import Rounds, cut_lineage, release

_EXACT = "decimal(28,9)"
#: Modularity that a round must bring to go on.
TOLERANCE = 1e-7
#: Gains are compared in so many places.
_PLACES = 9
#: The smallest share of the vertices that a graph goes down to is one in so many.
_FEWEST = 16
#: Rounds in a row without a gain in any graph after which a level ends, though some vertex may still see one.
_IDLE = 2


def undirected(graph: Graph) -> DataFrame:
    """``(keys, src, dst, weight)``: each link from both ends, one row per pair; a loop counts twice."""
    keys = graph_keys(graph.vertices)
    weight = F.col("weight").cast(_EXACT)
    ends = graph.edges.where("weight > 0 AND src IS NOT NULL AND dst IS NOT NULL").select(*keys, F.inline(F.array(
        F.struct("src", "dst", weight.alias("weight")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), weight.alias("weight")))))
    return ends.groupBy(*keys, "src", "dst").agg(F.sum("weight").cast(_EXACT).alias("weight"))


def _degrees(links: DataFrame, keys: list[str]) -> DataFrame:
    return links.groupBy(*keys, F.col("src").alias("id")).agg(F.sum("weight").cast(_EXACT).alias("degree"))


def _at_graph(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of a graph at its rows; without graph ids they are one row."""
    if keys:
        return rows.join(facts, keys)
    one = F.lit(1).alias("__one")
    return rows.select("*", one).join(F.broadcast(facts.select("*", one)), "__one").drop("__one")


def _totals(placed: DataFrame, keys: list[str]) -> DataFrame:
    return placed.groupBy(*keys, "community").agg(F.sum("degree").cast(_EXACT).alias("total"))


def _doubled(placed: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, m2)``: twice the weight of a graph."""
    return placed.groupBy(*keys).agg(F.sum("degree").cast("double").alias("m2"))


def best_moves(links: DataFrame, placed: DataFrame, keys: list[str], moving: Column | None = None) -> DataFrame:
    """``(keys, id, degree, community, best, gain)`` for ``placed(keys, id, degree, community)``.

    ``best`` is where a vertex gains most, its own community where nothing is better, and of equals the smallest; ``gain`` is
    the modularity a move there alone would bring. Vertices that ``moving`` leaves out stay.
    """
    movers = placed if moving is None else placed.where(moving)
    # Totals go with the communities of the vertices, so what is made per link is shuffled to its end, its option and its vertex only.
    known = placed.select(*keys, "id", "community").join(_totals(placed, keys), [*keys, "community"])
    around = known.select(*keys, F.col("id").alias("dst"), F.col("community").alias("target"), "total")
    votes = links.where("src <> dst").join(around, [*keys, "dst"]).select(
        *keys, F.col("src").alias("id"), "target", F.col("weight").cast(_EXACT).alias("weight"), "total")
    chosen = known if moving is None else known.join(movers.select(*keys, "id"), [*keys, "id"], "left_semi")
    own = chosen.select(*keys, "id", F.col("community").alias("target"), F.lit(0).cast(_EXACT).alias("weight"), "total")
    options = votes.unionByName(own).groupBy(*keys, "id", "target").agg(
        F.sum("weight").cast("double").alias("inside"), F.max("total").alias("total"))
    scored = _at_graph(options.join(movers, [*keys, "id"]), _doubled(placed, keys), keys)
    stays = F.col("target") == F.col("community")
    others = F.col("total").cast("double") - F.when(stays, F.col("degree").cast("double")).otherwise(0.0)
    worth = F.round(F.col("inside") - F.col("degree").cast("double") * others / F.col("m2"), _PLACES)
    ranked = scored.withColumn("worth", worth).groupBy(*keys, "id").agg(
        F.min(F.struct((-F.col("worth")).alias("less"), (~stays).alias("moves"), F.col("target"))).alias("b"),
        F.max(F.when(stays, F.col("worth"))).alias("now"), F.first("m2").alias("m2"))
    chosen = ranked.select(*keys, "id", F.col("b.target").alias("best"), (2 * (-F.col("b.less") - F.col("now")) / F.col("m2")).alias("gain"))
    joined = placed.join(chosen, [*keys, "id"], "left")
    return joined.select(*keys, "id", "degree", "community", F.coalesce("best", "community").alias("best"),
                         F.coalesce("gain", F.lit(0.0)).alias("gain"))


def _quality(links: DataFrame, placed: DataFrame, keys: list[str], community: str) -> DataFrame:
    """``(keys, quality)``: the modularity of each graph."""
    src, dst = (placed.select(*keys, F.col("id").alias(e), F.col(community).alias(f"{e}_in")) for e in ("src", "dst"))
    inside = links.join(src, [*keys, "src"]).join(dst, [*keys, "dst"]).where("src_in = dst_in").groupBy(*keys).agg(
        F.sum("weight").cast("double").alias("inside"))
    named = placed.select(*keys, "degree", F.col(community).alias("community"))
    squares = _at_graph(_totals(named, keys), _doubled(named, keys), keys).groupBy(*keys).agg(
        F.sum((F.col("total").cast("double") / F.col("m2")) ** 2).alias("squares"), F.first("m2").alias("m2"))
    met = squares.join(inside, keys, "left") if keys else _at_graph(squares, inside, keys)
    return met.select(*keys, (F.coalesce("inside", F.lit(0.0)) / F.col("m2") - F.col("squares")).alias("quality"))


def _settled(links: DataFrame, start: DataFrame, keys: list[str], max_rounds: int, held: Rounds, history: list | None) -> DataFrame:
    """``start`` after rounds of moves that gain; ``history`` takes each half-round's modularities."""
    placed = start
    # `share`: one vertex in so many moves in a half-round of this graph. `wish`: the largest gain a vertex saw in the last round.
    quality = held.cut(_quality(links, placed, keys, "community").withColumn("share", F.lit(2)).withColumn("wish", F.lit(0.0)).withColumn("gained", F.lit(0.0)))
    idle = 0
    for turn in range(2 * max_rounds):
        shares = quality.select(*keys, "share")
        half, at_half = (F.pmod(F.xxhash64(end, F.lit(turn // 2)), F.col("share")) == turn % 2 for end in ("id", "src"))
        # Links of vertices that stay tell nothing about a move.
        moving = _at_graph(links, shares, keys).where(at_half).drop("share")
        moved = held.cut(best_moves(moving, _at_graph(placed, shares, keys), keys, half))
        after = _quality(links, moved, keys, "best").withColumnRenamed("quality", "after")
        wishes = moved.groupBy(*keys).agg(F.max("gain").alias("now"))
        better = F.col("after") > F.col("quality")
        # A graph that goes back tries again with fewer vertices, and with half of them after a gain.
        share = F.when(better, 2).when(F.col("after") == F.col("quality"), F.col("share")).otherwise(F.least(F.col("share") * 2, F.lit(_FEWEST)))
        last, quality = quality, held.cut(_at_graph(_at_graph(quality, after, keys), wishes, keys).select(
            *keys, F.greatest("quality", "after").alias("quality"), share.alias("share"), better.alias("better"),
            (F.greatest("wish", "now") if turn % 2 else F.col("now")).alias("wish"),
            (F.greatest(F.col("after") - F.col("quality"), F.lit(0.0)) + (F.col("gained") if turn % 2 else F.lit(0.0))).alias("gained")))
        old, placed = placed, held.cut(_at_graph(moved, quality.select(*keys, "better"), keys).select(
            *keys, "id", "degree", F.when(F.col("better"), F.col("best")).otherwise(F.col("community")).alias("community")))
        for done in (last, moved, old):
            if done is not start:
                release(done)
        if history is not None:
            history.append({tuple(r[k] for k in keys): r.quality for r in quality.collect()})
        if turn % 2:
            most = quality.agg(F.max("gained"), F.max(F.when(F.col("share") > 2, 1.0).otherwise(F.col("wish")))).first()
            # Two neighbours that want each other's place may be in one half; the next round deals them anew.
            idle = idle + 1 if (most[0] or 0.0) <= TOLERANCE else 0
            if idle == _IDLE or (most[1] or 0.0) <= TOLERANCE:
                break
    return placed


def modularity_communities(
    graph: Graph, max_levels: int = 6, max_rounds: int = 10, history: list | None = None
) -> DataFrame:
    """``(id, community)``: communities by local moving and contraction, named by their smallest vertex.

    Vertices without a positive link are communities of their own. A list given as ``history`` gets the modularity of each
    graph after each half-round, for tests and reports of few graphs.
    """
    keys = graph_keys(graph.vertices)
    with Rounds() as held:
        links = held.cut(undirected(graph))
        names = held.cut(graph.vertices.where("id IS NOT NULL").select(*keys, "id", F.col("id").alias("community")))
        for _ in range(max_levels):
            start = held.cut(_degrees(links, keys).withColumn("community", F.col("id")))
            placed = _settled(links, start, keys, max_rounds, held, history)
            above = placed.select(*keys, F.col("id").alias("community"), F.col("community").alias("next"))
            names = held.cut(names.join(above, [*keys, "community"], "left").select(
                *keys, "id", F.coalesce("next", "community").alias("community")), instead_of=names)
            if placed.where("community <> id").isEmpty():
                break
            src, dst = (placed.select(*keys, F.col("id").alias(e), F.col("community").alias(f"new_{e}")) for e in ("src", "dst"))
            links = held.cut(links.join(src, [*keys, "src"]).join(dst, [*keys, "dst"]).groupBy(
                *keys, F.col("new_src").alias("src"), F.col("new_dst").alias("dst")).agg(
                F.sum("weight").cast(_EXACT).alias("weight")), instead_of=links)
        least = names.groupBy(*keys, "community").agg(F.min("id").alias("least"))
        return cut_lineage(names.join(least, [*keys, "community"]).select(*keys, "id", F.col("least").alias("community")))
