"""The three graph workflows, for one request or for a table of requests.

What a search finds is written to the shared folder once: building the edges
reads it several times, and the search must not run as often. Whether a side is
broadcast or merged is left to Spark, that measures it at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_terms
from ..operators.edges import citation_edges, star_edges
from ..operators.similarity import similarity_edges
from ..schema import GRAPH_ID, Corpus, Graph
from ..sources import search
from ..sources.keyword_index import KeywordIndex
from ..storage import cut_lineage


def keyword_vertices(papers: DataFrame) -> DataFrame:
    """``id, title, year, abstract, vector[, authors], tldr`` of paper records."""
    authors = ["authors"] if "authors" in papers.columns else []
    keys = [GRAPH_ID] if GRAPH_ID in papers.columns else []
    return papers.select(
        *keys, F.col("paperId").alias("id"), "title", "year", "abstract",
        F.col("embedding.vector").alias("vector"), *authors, F.col("tldr.text").alias("tldr"),
    )


def citation_vertices(papers: DataFrame) -> DataFrame:
    """``id, title, year, vector`` of paper records."""
    keys = [GRAPH_ID] if GRAPH_ID in papers.columns else []
    return papers.select(
        *keys, F.col("paperId").alias("id"), "title", "year", F.col("embedding.vector").alias("vector"))


def publication_vertices(papers: DataFrame) -> DataFrame:
    """``id, title, venue, year, vector`` of paper records."""
    keys = [GRAPH_ID] if GRAPH_ID in papers.columns else []
    return papers.select(
        *keys, F.col("paperId").alias("id"), "title", "venue", "year", F.col("embedding.vector").alias("vector"))


def resolve_central(papers: DataFrame, central: str | None, aliases: DataFrame | None = None) -> str | None:
    """The ``paperId`` behind ``central``, or None when no paper has it.

    ``aliases(alias, paperId)`` may name papers by other ids.
    """
    if not central:
        return None
    names = [central]
    if aliases is not None:
        named = aliases.where(F.col("alias") == central).agg(F.min("paperId").alias("paperId")).first()
        names += [named.paperId] if named.paperId else []
    found = papers.where(F.col("paperId").isin(names)).agg(F.min("paperId").alias("paperId")).first()
    return found.paperId


def star_or_citation(
    vertices: DataFrame, citations: DataFrame, central: str | None, min_similarity: float | None = None
) -> DataFrame:
    """Star edges when there is a central paper, citation edges otherwise."""
    if central is None:
        return citation_edges(vertices, citations, min_similarity)
    return star_edges(vertices, citations, central, min_similarity)


def _records_of(papers: DataFrame, members: DataFrame) -> DataFrame:
    """Records of the papers listed in ``members(paperId[, graph_id])``."""
    return papers.join(members, "paperId")


def keyword_graph(
    corpus: Corpus,
    keywords: str | Sequence[str],
    limit: int | None = None,
    central: str | None = None,
    min_similarity: float | None = None,
    aliases: DataFrame | None = None,
    index: KeywordIndex | None = None,
) -> Graph:
    """Graph of the papers a keyword search finds, around ``central`` if given.

    ``limit`` takes only the best hits; None takes every hit. With an ``index`` of the corpus no text is searched.
    """
    if index is None:
        hits = search.keyword_search(corpus.papers, keywords, limit).drop("score")
    else:
        hits = corpus.papers.join(index.search(keywords, limit).select("paperId"), "paperId", "left_semi")
    centre = resolve_central(corpus.papers, central, aliases)
    if centre is not None:
        added = search.lookup_ids(corpus.papers, [centre])
        hits = hits.where(F.col("paperId") != centre).unionByName(added)
    vertices = cut_lineage(keyword_vertices(hits))
    return Graph(vertices, star_or_citation(vertices, corpus.citations, centre, min_similarity))


def keyword_graphs(
    corpus: Corpus, queries: DataFrame, limit: int | None = None, index: KeywordIndex | None = None
) -> Graph:
    """Graphs for ``queries(graph_id, keywords[, central])``, comma-separated keywords.

    A request whose ``central`` is a known paper gets a star around it, the
    others citation edges. With an ``index`` of the corpus no text is searched.
    """
    asked = queries.select(GRAPH_ID, parse_terms(F.col("keywords")).alias("terms"))
    found = search.keyword_hits_many(corpus.papers, asked, limit) if index is None else index.search_many(asked, limit)
    members = found.select(GRAPH_ID, "paperId")
    centres = None
    if "central" in queries.columns:
        wanted = queries.select(GRAPH_ID, F.col("central").alias("paperId")).where(F.col("paperId").isNotNull())
        centres = cut_lineage(search.lookup_ids(wanted, corpus.papers))
        members = members.unionByName(centres).distinct()
    vertices = cut_lineage(keyword_vertices(_records_of(corpus.papers, members)))
    if centres is None:
        return Graph(vertices, citation_edges(vertices, corpus.citations))
    return Graph(vertices, star_edges(vertices, corpus.citations, centres.select(GRAPH_ID, F.col("paperId").alias("id"))))


def paper_id_graph(
    corpus: Corpus, seed_ids: Sequence[str] | DataFrame, min_similarity: float | None = None
) -> Graph:
    """Seed papers, the papers they cite, and every citation among them.

    ``seed_ids(paperId)`` may carry ``graph_id`` to build many graphs at once.
    """
    papers, citations = corpus.papers, corpus.citations
    keys = []
    if isinstance(seed_ids, DataFrame):
        keys = [GRAPH_ID] if GRAPH_ID in seed_ids.columns else []
        seeds = search.lookup_ids(seed_ids.select(*keys, "paperId").distinct(), papers)
    else:
        seeds = search.lookup_ids(papers, seed_ids).select("paperId")
    seeds = cut_lineage(seeds)
    cited = citations.join(seeds.withColumnRenamed("paperId", "src"), "src")
    members = seeds.unionByName(cited.select(*keys, F.col("dst").alias("paperId"))).distinct()
    vertices = cut_lineage(citation_vertices(_records_of(papers, members)))
    return Graph(vertices, citation_edges(vertices, citations, min_similarity))


def publication_graph(
    corpus: Corpus,
    publication: str,
    year: int,
    limit: int | None = None,
    min_similarity: float = 0.0,
) -> Graph:
    """Similarity graph of the papers of one venue and year.

    ``limit`` takes only the first papers by id; None takes every paper.
    """
    hits = search.publication_search(corpus.papers, publication, year, limit)
    vertices = cut_lineage(publication_vertices(hits))
    return Graph(vertices.drop("vector"), similarity_edges(vertices, min_similarity))


def publication_graphs(corpus: Corpus, queries: DataFrame, min_similarity: float = 0.0) -> Graph:
    """Similarity graphs for ``queries(graph_id, publication, year)``, every matching paper."""
    vertices = cut_lineage(publication_vertices(search.publication_hits_many(corpus.papers, queries)))
    return Graph(vertices.drop("vector"), similarity_edges(vertices, min_similarity))


def venue_year_graphs(corpus: Corpus, min_similarity: float = 0.0) -> Graph:
    """One similarity graph per exact venue and year, for the whole corpus.

    The pair itself is the graph's key, so no join picks the papers.
    """
    named = F.concat_ws("|", F.coalesce("venue", F.lit("")), "year")
    papers = corpus.papers.where(F.col("year").isNotNull()).withColumn(GRAPH_ID, named)
    vertices = cut_lineage(publication_vertices(papers))
    return Graph(vertices.drop("vector"), similarity_edges(vertices, min_similarity))
