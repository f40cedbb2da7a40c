"""Neighbourhoods, induced subgraphs and selection by property."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import Graph, graph_keys
from ..storage import Rounds, cut_lineage, shuffled_rows
from .edges import symmetrize

#: Longer lists of chosen ids are joined, shorter ones become a filter.
FILTER_IDS = 1000

# Fixed value: how far a highlighted neighbourhood reaches.
DEGREES = 2


def _ids(vertices: DataFrame, chosen: DataFrame | Sequence[str]) -> DataFrame:
    keys = graph_keys(vertices)
    if not isinstance(chosen, DataFrame):
        listed = sorted(set(chosen))
        if len(listed) <= FILTER_IDS:
            return vertices.select(*keys, "id").where(F.col("id").isin(listed))
        chosen = vertices.sparkSession.createDataFrame([(i,) for i in listed], "id string")
    shared = [*[k for k in keys if k in chosen.columns], "id"]
    return vertices.select(*keys, "id").join(chosen.select(*shared).distinct(), shared, "left_semi")


def neighborhood(graph: Graph, chosen: DataFrame | Sequence[str], degrees: int = DEGREES) -> DataFrame:
    """Every vertex with ``hop``: distance to the chosen vertices, null beyond ``degrees``.

    Breadth first: a round follows only the vertices the last round found.
    Links are written once; for the few rounds of a neighbourhood no layout is kept.
    """
    keys = graph_keys(graph.vertices)
    with Rounds() as rounds:
        links = rounds.cut(symmetrize(graph.edges.select(*keys, "src", "dst")))
        reached = rounds.cut(_ids(graph.vertices, chosen).withColumn("hop", F.lit(0)))
        for hop in range(1, degrees + 1):
            frontier = reached.where(F.col("hop") == hop - 1).select(*keys, F.col("id").alias("src"))
            touched = links.join(frontier, [*keys, "src"], "left_semi").select(*keys, F.col("dst").alias("id")).distinct()
            fresh = touched.join(reached, [*keys, "id"], "left_anti").withColumn("hop", F.lit(hop))
            reached = rounds.cut(reached.unionByName(fresh), instead_of=reached)
        return cut_lineage(graph.vertices.select(*keys, "id").join(reached, [*keys, "id"], "left"))


#: Requests that share one traversal of the links, one bit of a long each.
_BITS = 64
#: Links of a vertex, about, before they are counted.
_LINKS = 8


def neighborhood_many(graph: Graph, requests: DataFrame, degrees: int = DEGREES) -> DataFrame:
    """``(request, id, hop)`` for ``requests(request, id)``, the vertices around each request's chosen ones, in one traversal.

    A round sends one mask per vertex and block of 64 requests, whatever the number of requests in it: each has
    a bit, masks that meet are or-ed, on the map side first, and only new bits go on. Shuffles get more partitions
    with the rows there are. Vertices beyond ``degrees`` have no row.
    """
    keys = graph_keys(graph.vertices)
    asked = [k for k in keys if k in requests.columns]
    at = [*keys, "block", "id"]
    spark = graph.vertices.sparkSession
    with Rounds() as rounds:
        n_vertices = graph.vertices.count()
        with shuffled_rows(spark, n_vertices * _LINKS):
            links = rounds.cut(symmetrize(graph.edges.select(*keys, "src", "dst")).distinct())
        n_links = links.count()
        # Names are spread over blocks by a hash, and numbered inside their block.
        names = requests.where(F.col("request").isNotNull()).select("request").distinct()
        blocks = F.greatest(F.ceil(names.agg(F.count(F.lit(1))).scalar() / _BITS), F.lit(1))
        spread = names.withColumn("part", F.pmod(F.xxhash64("request"), blocks))
        place = F.row_number().over(Window.partitionBy("part").orderBy("request")) - 1
        numbered = rounds.cut(spread.withColumn("place", place).select(
            "request", F.concat_ws("-", "part", F.floor(F.col("place") / _BITS)).alias("block"),
            F.expr(f"shiftleft(1L, cast(place % {_BITS} as int))").alias("bit")))
        chosen = requests.join(numbered, "request").select(*asked, "block", "id", "bit")
        start = graph.vertices.select(*keys, "id").join(chosen, [*asked, "id"]).groupBy(*at).agg(F.bit_or("bit").alias("new"))
        with shuffled_rows(spark, n_vertices):
            reached = rounds.cut(start.withColumn("seen", F.col("new")).withColumn("hop", F.lit(0)))
        found = [reached]
        for hop in range(1, degrees + 1):
            frontier = reached.where("new <> 0").select(*keys, "block", F.col("id").alias("src"), "new")
            arrived = links.join(frontier, [*keys, "src"]).groupBy(*keys, "block", F.col("dst").alias("id")).agg(F.bit_or("new").alias("came"))
            inside = arrived.join(graph.vertices.select(*keys, "id"), [*keys, "id"], "left_semi")
            met = reached.select(*at, "seen").join(inside, at, "full")
            seen, came = F.coalesce("seen", F.lit(0)), F.coalesce("came", F.lit(0))
            # What the frontier sends, at the links of an average vertex.
            sent = reached.count() * -(-n_links // max(n_vertices, 1))
            with shuffled_rows(spark, n_vertices + n_links + sent):
                reached = rounds.cut(met.select(*at, came.bitwiseAND(F.bitwise_not(seen)).alias("new"),
                                                seen.bitwiseOR(came).alias("seen"), F.lit(hop).alias("hop")))
            found.append(reached)
        every = found[0].select(*at, "new", "hop")
        for later in found[1:]:
            every = every.unionByName(later.select(*at, "new", "hop"))
        told = every.where("new <> 0").join(numbered, "block").where(F.col("new").bitwiseAND(F.col("bit")) != 0)
        with shuffled_rows(spark, sum(r.count() for r in found)):
            return cut_lineage(told.select(*keys, "request", "id", "hop"))


def induced_subgraph(graph: Graph, chosen: DataFrame | Sequence[str]) -> Graph:
    """The chosen vertices and the edges with both ends among them."""
    keys = graph_keys(graph.vertices)
    ids = _ids(graph.vertices, chosen)
    vertices = graph.vertices.join(ids, [*keys, "id"], "left_semi")
    edges = graph.edges
    if not isinstance(chosen, DataFrame) and len(set(chosen)) <= FILTER_IDS:
        listed = sorted(set(chosen))
        return Graph(vertices, edges.where(F.col("src").isin(listed) & F.col("dst").isin(listed)))
    for end in ("src", "dst"):
        edges = edges.join(ids.withColumnRenamed("id", end), [*keys, end], "left_semi")
    return Graph(vertices, edges.select(*graph.edges.columns))


def _matches(df: DataFrame, name: str, values: Sequence[str]) -> Column:
    """Value printed as text is in ``values``; zero, NaN, false and empty text never match."""
    value, kind = F.col(name), df.schema[name].dataType.typeName()
    if kind == "string":
        return (value != "") & value.isin(list(values))
    if kind == "boolean":
        return value & F.lit("true" in values)
    printed = value.cast("string")
    if kind in ("double", "float"):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        printed = F.when(whole, value.cast("long").cast("string")).otherwise(printed)
        return (value != 0) & ~F.isnan(value) & printed.isin(list(values))
    return (value != 0) & printed.isin(list(values))


def nodes_by_property(vertices: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Ids of vertices whose property ``name`` has one of the values."""
    return vertices.where(_matches(vertices, name, values)).select(*graph_keys(vertices), "id")


def nodes_by_edge_property(edges: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Ids at either end of edges whose property ``name`` has one of the values."""
    hits = edges.where(_matches(edges, name, values))
    return hits.select(*graph_keys(edges), F.explode(F.array("src", "dst")).alias("id")).distinct()
