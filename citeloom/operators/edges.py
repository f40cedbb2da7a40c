"""Edge construction: citation, star and hub edges with cosine weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine, norm
from ..schema import GRAPH_ID, graph_keys


def assert_unique(vertices: DataFrame) -> DataFrame:
    """``vertices`` if every id occurs once (in each graph), else an error.

    Operators that attach vertex values multiply rows on a repeated id.
    """
    keys = graph_keys(vertices)
    again = vertices.groupBy(*keys, "id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    found = [tuple(r) for r in again.orderBy(*keys, "id").limit(5).collect()]
    if found:
        raise ValueError(f"repeated vertex ids such as {found}")
    return vertices


def _end(vertices: DataFrame, end: str) -> DataFrame:
    """Vertex vectors and norms, named for one end of an edge."""
    return vertices.select(
        *graph_keys(vertices),
        F.col("id").alias(end),
        F.col("vector").alias(f"{end}_vector"),
        norm(F.col("vector")).alias(f"{end}_norm"),
    )


def _weight() -> Column:
    return cosine(F.col("src_vector"), F.col("dst_vector"), F.col("src_norm"), F.col("dst_norm"))


def _per_graph(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """Each pair once per graph that holds its source.

    Going by source keeps this small: a paper in many graphs cites few others,
    while it may be cited by very many.
    """
    members = vertices.select(*graph_keys(vertices), F.col("id").alias("src"))
    return members.join(pairs, ["src"])


def weigh(pairs: DataFrame, vertices: DataFrame, min_similarity: float | None = None) -> DataFrame:
    """Pairs with both ends among ``vertices``, weighted by cosine.

    Each end needs one join, which restricts and attaches the vector at once.
    The narrow pairs are shuffled first; only pairs whose target exists carry
    a vector through the second shuffle. Spark splits the partitions of
    often-cited targets and long reference lists at run time, and broadcasts
    vertices that turn out small.
    """
    keys = graph_keys(vertices)
    extra = [c for c in pairs.columns if c not in ("src", "dst", *keys)]
    if keys and GRAPH_ID not in pairs.columns:
        pairs = _per_graph(pairs, vertices)
    half = pairs.join(_end(vertices, "dst"), [*keys, "dst"])
    whole = half.join(_end(vertices, "src"), [*keys, "src"])
    edges = whole.select(*keys, "src", "dst", _weight().alias("weight"), *extra)
    return edges if min_similarity is None else edges.where(F.col("weight") >= min_similarity)


def citation_edges(vertices: DataFrame, citations: DataFrame, min_similarity: float | None = None) -> DataFrame:
    """Directed citations with both ends among ``vertices``."""
    edges = weigh(citations.select("src", "dst"), vertices, min_similarity)
    return edges.withColumn("edge_type", F.lit("citation"))


def _centres(vertices: DataFrame, central: str | DataFrame) -> DataFrame:
    """``([graph_id,] centre)``, one row per graph that has a central paper."""
    keys = graph_keys(vertices)
    if isinstance(central, DataFrame):
        return central.where(F.col("id").isNotNull()).select(*keys, F.col("id").alias("centre"))
    if keys:
        return vertices.select(*keys).distinct().withColumn("centre", F.lit(central))
    return vertices.sparkSession.createDataFrame([(central,)], "centre string")


def central_links(vertices: DataFrame, citations: DataFrame, central: str | DataFrame) -> DataFrame:
    """``([graph_id,] centre, id, edge_type, outward)``: every edge between a centre and a vertex of its graph.

    Real citations come first; a vertex that neither cites nor is cited by
    the central paper gets a ``fallback`` link. A self-citation of the
    central paper counts in both directions.
    """
    keys = graph_keys(vertices)
    centres = _centres(vertices, central)
    pairs = citations.select("src", "dst")
    if not isinstance(central, DataFrame):
        # A filter of the scan: the citations of all other papers are never shuffled.
        pairs = pairs.where((F.col("src") == F.lit(central)) | (F.col("dst") == F.lit(central)))
    out = pairs.join(centres, F.col("src") == F.col("centre")).select(
        *keys, "centre", F.col("dst").alias("id"), F.lit("central_cites").alias("edge_type"), F.lit(True).alias("outward"))
    into = pairs.join(centres, F.col("dst") == F.col("centre")).select(
        *keys, "centre", F.col("src").alias("id"), F.lit("cites_central").alias("edge_type"), F.lit(False).alias("outward"))
    ids = vertices.select(*keys, "id")
    linked = out.unionByName(into).join(ids, [*keys, "id"], "left_semi")
    others = ids.join(centres, keys) if keys else ids.withColumn("centre", centres.scalar())
    fallback = (
        others.where(F.col("id") != F.col("centre"))
        .join(linked.select(*keys, "id"), [*keys, "id"], "left_anti")
        .withColumns({"edge_type": F.lit("fallback"), "outward": F.lit(True)})
    )
    return linked.unionByName(fallback)


def _weigh_star(links: DataFrame, vertices: DataFrame, central: str | DataFrame) -> DataFrame:
    """The links of :func:`central_links` as edges weighted by cosine.

    All links of a graph share its centre, so only the other end is joined by shuffle; without graph ids, the
    centre is one paper, whose vector every task gets.
    """
    keys = graph_keys(vertices)
    hubs = _end(vertices, "centre")
    if isinstance(central, DataFrame):
        hubs = hubs.join(_centres(vertices, central), [*keys, "centre"], "left_semi")
    else:
        hubs = hubs.where(F.col("centre") == F.lit(central))
    met = links.join(_end(vertices, "id"), [*keys, "id"]).join(hubs if keys else F.broadcast(hubs), [*keys, "centre"])
    return met.select(
        *keys, F.when(F.col("outward"), F.col("centre")).otherwise(F.col("id")).alias("src"),
        F.when(F.col("outward"), F.col("id")).otherwise(F.col("centre")).alias("dst"),
        cosine(F.col("centre_vector"), F.col("id_vector"), F.col("centre_norm"), F.col("id_norm")).alias("weight"), "edge_type")


def star_edges(
    vertices: DataFrame, citations: DataFrame, central: str | DataFrame, min_similarity: float | None = None
) -> DataFrame:
    """Citations among the other vertices plus a star around the central paper of each graph.

    ``central`` is one id for all graphs, or a frame ``([graph_id,] id)`` with
    one row per graph; a graph without a row there has citation edges only.
    """
    keys = graph_keys(vertices)
    centres = _centres(vertices, central)
    among = weigh(citations.select("src", "dst"), vertices)
    if keys:
        among = among.join(centres, keys, "left")
        kind = F.when(F.col("centre").isNull(), "citation").otherwise("seed_cite")
    else:
        among, kind = among.withColumn("centre", centres.scalar()), F.lit("seed_cite")
    apart = F.col("centre").isNull() | ((F.col("src") != F.col("centre")) & (F.col("dst") != F.col("centre")))
    ordinary = among.where(apart).select(*keys, "src", "dst", "weight", kind.alias("edge_type"))

    links = central_links(vertices, citations, central)
    edges = ordinary.unionByName(_weigh_star(links, vertices, central))
    return edges if min_similarity is None else edges.where(F.col("weight") >= min_similarity)


def hub_edges(vertices: DataFrame) -> DataFrame:
    """Both directions between the smallest id and every other vertex, weight 1."""
    keys = graph_keys(vertices)
    if keys:
        ids = vertices.select(*keys, "id")
        hubs = ids.groupBy(*keys).agg(F.min("id").alias("hub"))
        paired = ids.join(hubs, keys)
    else:
        paired = vertices.select("id").withColumn("hub", vertices.agg(F.min("id")).scalar())
    both = F.array(
        F.struct(F.col("hub").alias("src"), F.col("id").alias("dst")),
        F.struct(F.col("id").alias("src"), F.col("hub").alias("dst")),
    )
    return (
        paired.where(F.col("id") != F.col("hub"))
        .select(*keys, F.inline(both))
        .withColumn("weight", F.lit(1.0))
    )


def symmetrize(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, in one pass over the input."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    both = F.array(
        F.struct(F.col("src"), F.col("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    turned = edges.select(*rest, F.inline(both))
    return turned.select(*edges.columns)


def mixed_edges(citations: DataFrame, similar: DataFrame) -> DataFrame:
    """Citation and similarity edges in one table, told apart by ``edge_type``."""
    common = [c for c in citations.columns if c in similar.columns and c != "edge_type"]
    return (
        citations.select(*common).withColumn("edge_type", F.lit("citation"))
        .unionByName(similar.select(*common).withColumn("edge_type", F.lit("similarity")))
    )
