"""Edges of further kinds: shared authors and shared venues.

A paper is linked to a node for each author, and to one for its venue and
year. Two papers share an author exactly when they are two steps apart, so
the relation is complete while its size stays linear: an author of a third of
all papers does not cause a quadratic number of pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Corpus

AUTHOR_PREFIX = "author:"
VENUE_PREFIX = "venue:"


def coauthor_edges(corpus: Corpus) -> DataFrame:
    """Paper to author node, weight 1."""
    return corpus.authorships.select(
        F.col("paperId").alias("src"),
        F.concat(F.lit(AUTHOR_PREFIX), "authorId").alias("dst"),
        F.lit(1.0).alias("weight"),
        F.lit("authored_by").alias("edge_type"),
    ).where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()


def venue_edges(corpus: Corpus) -> DataFrame:
    """Paper to the node of its venue and year, weight 1."""
    known = F.col("venue").isNotNull() & F.col("year").isNotNull()
    return corpus.papers.where(known).select(
        F.col("paperId").alias("src"),
        F.concat(F.lit(VENUE_PREFIX), "venue", F.lit("|"), F.col("year").cast("string")).alias("dst"),
        F.lit(1.0).alias("weight"),
        F.lit("published_in").alias("edge_type"),
    )


def hub_nodes(edges: DataFrame) -> DataFrame:
    """The author or venue nodes of such edges with their number of papers."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("papers"))


def related_papers(edges: DataFrame, paper_ids: DataFrame) -> DataFrame:
    """``(src, dst, weight)``: papers that share a node with the given papers, and how many nodes."""
    seeds = edges.join(paper_ids.select(F.col("id").alias("src")), "src", "left_semi")
    seeds = seeds.select(F.col("src").alias("seed"), F.col("dst")).distinct()
    shared = edges.select("src", "dst").join(seeds, "dst")
    return (
        shared.where(F.col("src") != F.col("seed"))
        .groupBy(F.col("seed").alias("src"), F.col("src").alias("dst"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
