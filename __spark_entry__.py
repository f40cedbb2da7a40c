
from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import GRAPH_ID, Graph
from citeloom.functions.text import join_terms, parse_terms, publication_query
from citeloom.functions.vectors import cosine
from citeloom.operators.community import connected_components, label_propagation, modularity
from citeloom.operators.dedup import dedup_papers
from citeloom.operators.edges import assert_unique, citation_edges, hub_edges, mixed_edges, star_edges
from citeloom.operators.hetero import coauthor_edges, hub_nodes, related_papers, venue_edges
from citeloom.operators.moving import best_moves, modularity_communities, undirected
from citeloom.operators.neighborhood import (
    induced_subgraph,
    neighborhood,
    neighborhood_many,
    nodes_by_edge_property,
    nodes_by_property,
)
from citeloom.operators.push import push_pagerank
from citeloom.operators.rank import pagerank
from citeloom.operators.report import graph_stats, top_ranked, viz_edges, viz_nodes
from citeloom.operators.similarity import similarity_pairs
from citeloom.plans import workflows as flows
from citeloom.sources import graph_files as files
from citeloom.sources import records, search
from citeloom.sources.keyword_index import KeywordIndex
from citeloom.sources.sample_corpus import sample_corpus, sample_papers, sample_records, table
from citeloom.storage import cut_lineage, n_files, scratch_path
from citeloom.streaming import stateful, updates

# Query parameters; the SQL below uses the same ones.
KEYWORDS = ["thtion", "ering"]
CENTRAL = "190"
ABSENT = "999999"
SEEDS = ["1", "2", "3"]
PUBLICATION, YEAR = "SRC1", 1998
MIN_SIMILARITY = 0.2
CLOSE = 0.05
RECORDS_PER_FILE = 50_000
#: How records to be read as a stream are kept.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _r(column: str | Column, name: str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6).alias(name)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[_r(c, c) if c in names else F.col(c) for c in df.columns])


def _citation_graph(spark: SparkSession, d: str) -> Graph:
    corpus = sample_corpus(spark, d)
    vertices = flows.publication_vertices(corpus.papers)
    return Graph(vertices, citation_edges(vertices, corpus.citations))


def _year_vertices(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The papers of each year as a graph of its own."""
    corpus = sample_corpus(spark, d)
    papers = corpus.papers.where("year IS NOT NULL").withColumn(GRAPH_ID, F.col("year").cast("string"))
    return flows.citation_vertices(papers), corpus.citations


def _year_graphs(spark: SparkSession, d: str) -> Graph:
    vertices, citations = _year_vertices(spark, d)
    return Graph(vertices, citation_edges(vertices, citations))


def _star_graph(spark: SparkSession, d: str) -> Graph:
    corpus = sample_corpus(spark, d, texts=False)
    vertices = flows.publication_vertices(corpus.papers)
    return Graph(vertices, star_edges(vertices, corpus.citations, CENTRAL))


def _cited_ids(spark: SparkSession, d: str) -> DataFrame:
    return sample_corpus(spark, d).citations.select(F.col("dst").alias("paperId"))


# --- sources -----------------------------------------------------------------


def q_explode_references(spark, d):
    return records.explode_references(sample_records(spark, d))


def q_dedup_papers(spark, d):
    # Three of the four copies below read the records.
    base = cut_lineage(sample_records(spark, d))
    bare = base.withColumn("embedding", F.lit(None).cast(base.schema["embedding"].dataType)).withColumn(
        "title", F.concat(F.lit("AA"), "title"))
    unlinked = base.withColumn("references", F.lit(None).cast(base.schema["references"].dataType)).withColumn(
        "title", F.concat(F.lit("zz"), "title"))
    nameless = base.withColumn("paperId", F.lit(None).cast("string"))
    copies = base.unionByName(bare).unionByName(unlinked).unionByName(nameless)
    return dedup_papers(copies, keep=["title", "embedding", "references"]).select(
        F.col("paperId").alias("id"), "title",
        F.col("embedding").isNotNull().cast("int").alias("has_vector"),
        F.coalesce(F.size("references"), F.lit(0)).alias("n_references"),
    )


def q_vertices_keyword(spark, d):
    v = flows.keyword_vertices(sample_records(spark, d))
    return v.select(
        "id", "title", "year", F.md5("abstract").alias("abstract_md5"),
        F.size("vector").alias("n_dims"),
        _r(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x), "vector_sum"),
        F.array_join(F.col("authors.name"), ",").alias("author_names"), "tldr",
    )


def q_keyword_search(spark, d):
    hits = search.keyword_search(sample_corpus(spark, d).papers, KEYWORDS)
    return hits.select(F.col("paperId").alias("id"), "title", "score")


def q_search_page(spark, d):
    hits = search.search_page(sample_corpus(spark, d).papers, "the", limit=200, offset=50)
    return hits.select(F.col("paperId").alias("id"), "score")


def q_search_preview(spark, d):
    return search.search_preview(sample_corpus(spark, d).papers, "tion")


def q_keyword_search_many(spark, d):
    asked = spark.createDataFrame(
        [("g1", ["tion"]), ("g2", KEYWORDS), ("g3", ["the", "tion"])], "graph_id string, terms array<string>")
    hits = search.keyword_hits_many(sample_corpus(spark, d).papers, asked)
    return hits.select(GRAPH_ID, F.col("paperId").alias("id"), "score")


def _index(spark: SparkSession, d: str) -> KeywordIndex:
    return KeywordIndex(spark, scratch_path(spark, "keyword-index")).build(sample_corpus(spark, d).papers)


def q_keyword_index_search(spark, d):
    return _index(spark, d).search(KEYWORDS).select(F.col("paperId").alias("id"), "score")


def q_keyword_index_top(spark, d):
    return _index(spark, d).search(["the", "tion", *KEYWORDS], limit=40, offset=10).select(F.col("paperId").alias("id"), "score")


def q_keyword_index_many(spark, d):
    asked = spark.createDataFrame(
        [("g1", ["tion"]), ("g2", KEYWORDS), ("g3", ["the", "tion"])], "graph_id string, terms array<string>")
    return _index(spark, d).search_many(asked, limit=30).select(GRAPH_ID, F.col("paperId").alias("id"), "score")


def q_keyword_index_update(spark, d):
    """Papers come in three batches; those of the second are sent again with their texts in the third."""
    papers = sample_corpus(spark, d).papers
    part = F.pmod(F.col("paperId").cast("long"), F.lit(3))
    index = KeywordIndex(spark, scratch_path(spark, "keyword-index")).build(papers.where(part == 0))
    later = papers.where(part == 1)
    index.update(later.withColumn("title", F.lit("thtion ering the")).withColumn("abstract", F.lit("tion")), 1)
    index.update(papers.where(part != 0), 2)
    merged = index.merge(scratch_path(spark, "keyword-index"))
    return merged.search(["the", *KEYWORDS], limit=100).select(F.col("paperId").alias("id"), "score")


def q_parse_terms(spark, d):
    docs = table(spark, d, "documents").withColumn("terms", parse_terms(F.col("text")))
    return docs.select(
        "doc_id",
        F.size("terms").alias("n_terms"),
        F.md5(join_terms(F.col("terms"))).alias("query_md5"),
        publication_query(F.col("source"), F.col("n_chars")).alias("publication_query"),
    )


def q_lookup_ids(spark, d):
    found = search.lookup_ids(sample_corpus(spark, d).papers, _cited_ids(spark, d))
    return found.select(F.col("paperId").alias("id"), "title")


def q_missing_ids(spark, d):
    spread = _cited_ids(spark, d).select((F.col("paperId").cast("long") * 10).cast("string").alias("paperId"))
    missing = search.missing_ids(sample_corpus(spark, d).papers, spread)
    return missing.select(F.col("paperId").alias("id"))


def q_publication_search(spark, d):
    hits = search.publication_search(sample_corpus(spark, d).papers, PUBLICATION, YEAR)
    return hits.select(F.col("paperId").alias("id"), "title", "venue", "year")


def q_ingest_json(spark, d):
    path = scratch_path(spark, "ingest")
    sample_records(spark, d).write.json(path)
    back = records.read_json(spark, path)
    return back.select(
        F.col("paperId").alias("id"), "title", "venue", "year",
        F.coalesce(F.size("references"), F.lit(0)).alias("n_references"),
        F.coalesce(F.size("authors"), F.lit(0)).alias("n_authors"),
        F.col("embedding.model").alias("model"),
        _r(F.aggregate("embedding.vector", F.lit(0.0), lambda s, x: s + x), "vector_sum"),
    )


def q_lookup_ids_strict(spark, d):
    found = search.lookup_ids_strict(sample_corpus(spark, d).papers, SEEDS)
    return found.select(F.col("paperId").alias("id"), "title")


def q_parse_json_column(spark, d):
    props = table(spark, d, "embeddings").select(
        F.to_json(F.struct(F.col("vec_id").alias("paperId"), F.col("label").cast("string").alias("year"),
                           F.col("label").alias("title"), F.lit("x").alias("extra"))).alias("value"))
    broken = table(spark, d, "embeddings").select(F.lit("no json").alias("value"))
    parsed = records.parse_json(props.unionByName(broken))
    return parsed.select(F.col("paperId").alias("id"), "title", "year")


def q_attach_embeddings(spark, d):
    papers = sample_papers(spark, d).drop("embedding")
    vectors = table(spark, d, "embeddings").where("label < 3").select(
        F.col("vec_id").cast("string").alias("paperId"), F.col("embedding").alias("vector"))
    joined = records.attach_embeddings(papers, vectors)
    return joined.select(F.col("paperId").alias("id"), "venue", F.size("embedding.vector").alias("n_dims"))


# --- functions ----------------------------------------------------------------


def q_cosine_pairs(spark, d):
    v = sample_papers(spark, d).select(
        F.col("paperId").alias("id"), F.col("embedding.vector").alias("a"),
        F.reverse("embedding.vector").alias("b"), F.slice("embedding.vector", 1, 32).alias("head"))
    none, empty = F.lit(None).cast("array<double>"), F.array().cast("array<double>")
    zero = F.transform("a", lambda x: x * 0.0)
    return v.select(
        "id", _r(cosine(F.col("a"), F.col("b")), "reversed"), _r(cosine(F.col("a"), F.col("head")), "prefix"),
        _r(cosine(F.col("a"), F.transform("a", lambda x: -x)), "opposite"),
        cosine(F.col("a"), none).alias("null_side"), cosine(empty, F.col("a")).alias("empty_side"),
        cosine(F.col("a"), zero).alias("zero_side"),
    )


# --- edges and graphs ---------------------------------------------------------


def q_citation_edges(spark, d):
    return _rounded(_citation_graph(spark, d).edges, "weight")


def q_star_edges(spark, d):
    return _rounded(_star_graph(spark, d).edges, "weight")


def q_star_edges_by_graph(spark, d):
    vertices, citations = _year_vertices(spark, d)
    centres = vertices.where("vector IS NOT NULL").groupBy(GRAPH_ID).agg(F.min("id").alias("id"))
    return _rounded(star_edges(vertices, citations, centres), "weight")


def q_star_of_known_paper(spark, d):
    corpus = sample_corpus(spark, d)
    vertices = flows.citation_vertices(corpus.papers)
    aliases = corpus.papers.select(F.concat(F.lit("ARXIV:"), "paperId").alias("alias"), "paperId")
    centre = flows.resolve_central(corpus.papers, f"ARXIV:{CENTRAL}", aliases)
    return _rounded(flows.star_or_citation(vertices, corpus.citations, centre), "weight")


def q_unique_vertices(spark, d):
    return assert_unique(flows.citation_vertices(sample_papers(spark, d))).select("id", "year")


def q_star_fallback(spark, d):
    return q_star_edges(spark, d).where("edge_type = 'fallback'").select("src", "dst", "weight")


def q_star_or_citation(spark, d):
    corpus = sample_corpus(spark, d)
    vertices = flows.citation_vertices(corpus.papers)
    centre = flows.resolve_central(corpus.papers, ABSENT)
    return _rounded(flows.star_or_citation(vertices, corpus.citations, centre), "weight")


def q_hub_edges(spark, d):
    return hub_edges(flows.citation_vertices(sample_papers(spark, d)))


def q_hub_edges_by_venue(spark, d):
    papers = sample_papers(spark, d).where("venue IS NOT NULL").withColumn(GRAPH_ID, F.col("venue"))
    return hub_edges(flows.citation_vertices(papers))


def q_keyword_graph_vertices(spark, d):
    g = flows.keyword_graph(sample_corpus(spark, d), KEYWORDS, limit=None, central=CENTRAL)
    return g.vertices.select("id", "title", "year", "tldr")


def q_keyword_graph_edges(spark, d):
    g = flows.keyword_graph(sample_corpus(spark, d), KEYWORDS, limit=None, central=CENTRAL)
    return _rounded(g.edges, "weight")


def q_keyword_graphs(spark, d):
    asked = spark.createDataFrame(
        [("g1", "tion"), ("g2", ", ".join(KEYWORDS)), ("g3", "the, tion")], "graph_id string, keywords string")
    return _rounded(flows.keyword_graphs(sample_corpus(spark, d), asked, limit=None).edges, "weight")


def q_keyword_star_graphs(spark, d):
    asked = spark.createDataFrame(
        [("g1", "tion", CENTRAL), ("g2", ", ".join(KEYWORDS), ABSENT), ("g3", "the, tion", None)],
        "graph_id string, keywords string, central string")
    return _rounded(flows.keyword_graphs(sample_corpus(spark, d), asked).edges, "weight")


def q_one_hop_vertices(spark, d):
    return flows.paper_id_graph(sample_corpus(spark, d), SEEDS).vertices.select("id", "title", "year")


def q_one_hop_edges(spark, d):
    return _rounded(flows.paper_id_graph(sample_corpus(spark, d), SEEDS).edges, "weight").drop("edge_type")


def q_one_hop_graphs(spark, d):
    corpus = sample_corpus(spark, d)
    seeds = corpus.papers.where("venue IS NOT NULL").select(F.col("venue").alias(GRAPH_ID), "paperId")
    return _rounded(flows.paper_id_graph(corpus, seeds).edges, "weight").drop("edge_type")


def q_similarity_pairs(spark, d):
    papers = sample_papers(spark, d).where("year IS NOT NULL").withColumn(
        GRAPH_ID, F.concat_ws("|", F.coalesce("venue", F.lit("")), "year"))
    return _rounded(similarity_pairs(flows.publication_vertices(papers), MIN_SIMILARITY), "weight")


def q_similarity_edges(spark, d):
    return _rounded(flows.venue_year_graphs(sample_corpus(spark, d), MIN_SIMILARITY).edges, "weight")


def q_publication_graph_edges(spark, d):
    g = flows.publication_graph(sample_corpus(spark, d), PUBLICATION, YEAR, limit=None, min_similarity=MIN_SIMILARITY)
    return _rounded(g.edges, "weight")


def q_publication_graphs(spark, d):
    asked = spark.createDataFrame(
        [("g1", "SRC1", 1998), ("g2", "src7", 1997), ("g3", "", 1996)], "graph_id string, publication string, year int")
    return _rounded(flows.publication_graphs(sample_corpus(spark, d), asked, MIN_SIMILARITY).edges, "weight")


def q_mixed_graph_edges(spark, d):
    corpus = sample_corpus(spark, d)
    similar = flows.venue_year_graphs(corpus, MIN_SIMILARITY).edges.select("src", "dst", "weight")
    return _rounded(mixed_edges(_citation_graph(spark, d).edges, similar), "weight")


def q_coauthor_edges(spark, d):
    return coauthor_edges(sample_corpus(spark, d, authors=True))


def q_venue_edges(spark, d):
    return venue_edges(sample_corpus(spark, d))


def q_venue_nodes(spark, d):
    return hub_nodes(venue_edges(sample_corpus(spark, d)))


def q_related_papers(spark, d):
    chosen = spark.createDataFrame([(CENTRAL,)], "id string")
    return related_papers(coauthor_edges(sample_corpus(spark, d, authors=True)), chosen)


def q_graph_stats(spark, d):
    return graph_stats(flows.venue_year_graphs(sample_corpus(spark, d), MIN_SIMILARITY))


# --- ranking and reports ------------------------------------------------------


def q_pagerank_citation(spark, d):
    return _rounded(pagerank(_citation_graph(spark, d)), "rank")


def q_pagerank_star(spark, d):
    return _rounded(pagerank(_star_graph(spark, d)), "rank")


def q_pagerank_similarity(spark, d):
    return _rounded(pagerank(flows.venue_year_graphs(sample_corpus(spark, d), MIN_SIMILARITY)), "rank")


def q_pagerank_normalized(spark, d):
    g = flows.venue_year_graphs(sample_corpus(spark, d), MIN_SIMILARITY)
    return _rounded(pagerank(g, normalize=True).select(GRAPH_ID, "id", "rank"), "rank")


def q_pagerank_citation_normalized(spark, d):
    g = _citation_graph(spark, d)
    close = Graph(g.vertices, g.edges.where(F.col("weight") >= CLOSE))
    return _rounded(pagerank(close, normalize=True).select("id", "rank"), "rank")


def q_pagerank_salted(spark, d):
    return _rounded(pagerank(_star_graph(spark, d), hot_floor=50).select("id", "rank"), "rank")


def q_pagerank_top10(spark, d):
    return _rounded(top_ranked(pagerank(_citation_graph(spark, d))).select("position", "id", "rank", "title"), "rank")


def q_top_by_graph(spark, d):
    ranks = pagerank(flows.venue_year_graphs(sample_corpus(spark, d), MIN_SIMILARITY))
    rounded = ranks.withColumn("rank", F.round("rank", 6))
    return top_ranked(rounded, 3).select(GRAPH_ID, "position", "id", "rank")


def q_viz_nodes(spark, d):
    return _rounded(viz_nodes(pagerank(_citation_graph(spark, d))), "size_scaled")


def q_viz_nodes_publication(spark, d):
    g = flows.venue_year_graphs(sample_corpus(spark, d), MIN_SIMILARITY)
    ranks = pagerank(g)
    rounded = ranks.withColumn("rank", F.round("rank", 6))
    return _rounded(viz_nodes(rounded, blank="", with_venue=True, top=3), "size_scaled")


def q_viz_edges(spark, d):
    return _rounded(viz_edges(_star_graph(spark, d).edges), "value")


# --- neighbourhoods -----------------------------------------------------------


def q_two_hop(spark, d):
    return neighborhood(_citation_graph(spark, d), [CENTRAL])


def q_three_hop(spark, d):
    g = _citation_graph(spark, d)
    return neighborhood(g, nodes_by_property(g.vertices, "venue", ["src3"]), degrees=3)


def q_induced_subgraph(spark, d):
    g = _citation_graph(spark, d)
    chosen = nodes_by_property(g.vertices, "year", ["1996", "1997", "1998"])
    return _rounded(induced_subgraph(g, chosen).edges, "weight")


def q_filter_nodes_by_prop(spark, d):
    return nodes_by_property(_citation_graph(spark, d).vertices, "year", ["1998", "1999"])


def q_filter_edges_by_prop(spark, d):
    return nodes_by_edge_property(_star_graph(spark, d).edges, "edge_type", ["cites_central", "seed_cite"])


# --- communities --------------------------------------------------------------


def q_connected_components(spark, d):
    return connected_components(_citation_graph(spark, d))


def q_label_propagation(spark, d):
    return label_propagation(_citation_graph(spark, d), rounds=4)


def q_modularity(spark, d):
    g = _citation_graph(spark, d)
    labels = g.vertices.select("id", F.coalesce("venue", F.lit("")).alias("label"))
    return _rounded(modularity(g, labels), "modularity")


def q_components_by_graph(spark, d):
    return connected_components(_year_graphs(spark, d))


def q_labels_by_graph(spark, d):
    return label_propagation(_year_graphs(spark, d), rounds=4)


def q_modularity_by_graph(spark, d):
    g = _year_graphs(spark, d)
    labels = g.vertices.select(GRAPH_ID, "id", (F.col("id").cast("long") % 3).cast("string").alias("label"))
    return _rounded(modularity(g, labels), "modularity")


# --- storage and streams ------------------------------------------------------


def q_roundtrip_vertices(spark, d):
    root = scratch_path(spark, "graph")
    files.write_vertices(flows.citation_vertices(sample_papers(spark, d)), root)
    return files.read_vertices(spark, root)


def q_roundtrip_edges(spark, d):
    root = scratch_path(spark, "graph")
    files.write_edges(_citation_graph(spark, d).edges, root)
    return _rounded(files.read_edges(spark, root), "weight")


def q_load_year_pruned(spark, d):
    root = scratch_path(spark, "graph")
    files.write_vertices(flows.citation_vertices(sample_papers(spark, d)), root)
    return files.read_vertices(spark, root, years=[YEAR])


def _streamed_edges(spark: SparkSession, d: str, arriving: DataFrame, known: DataFrame, citations: DataFrame) -> DataFrame:
    """Edges that a stream of records, all sent twice in about four batches of files, adds to a graph."""
    start = F.lit("2024-01-01").cast("timestamp")
    first = arriving.withColumn("ingest_ts", start + F.make_dt_interval(mins=F.col("paperId").cast("int")))
    again = first.withColumn("ingest_ts", F.col("ingest_ts") + F.make_dt_interval(days=F.lit(30)))
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "stream")
    # Files stay where the records are made: none is larger than a part of its task, and no task reads a batch.
    most = max(1, min(RECORDS_PER_FILE, table(spark, d, "orders").count() // 4))
    first.unionByName(again).write.options(maxRecordsPerFile=most, **PACKED).json(inbox)
    files_per_batch = max(1, n_files(spark, inbox) // 4)
    stream = updates.read_paper_stream(spark, inbox, max_files=files_per_batch)
    updates.append_papers(stream, known, out, f"{out}/progress", citations).awaitTermination()
    return updates.read_appended_edges(spark, out)


def q_streaming_dedup_edges(spark, d):
    vertices = flows.citation_vertices(sample_papers(spark, d))
    nothing = sample_corpus(spark, d).citations.limit(0)
    return _rounded(_streamed_edges(spark, d, sample_records(spark, d), vertices.limit(0), nothing), "weight")


def q_streaming_new_papers(spark, d):
    later = F.col("paperId").cast("long") % 2 == 1
    known = flows.citation_vertices(sample_papers(spark, d).where(~later))
    citations = sample_corpus(spark, d).citations.where(F.col("src").cast("long") % 2 == 0)
    added = _streamed_edges(spark, d, sample_records(spark, d).where(later), known, citations)
    return _rounded(citation_edges(known, citations).unionByName(added), "weight")


def q_streaming_state_edges(spark, d):
    """Half of the papers come by a stream with keyed state, all sent twice, in two calls."""
    later = F.col("paperId").cast("long") % 2 == 1
    known = flows.citation_vertices(sample_papers(spark, d).where(~later))
    citations = sample_corpus(spark, d).citations.where(F.col("src").cast("long") % 2 == 0)
    records = sample_records(spark, d).where(later).withColumn("ingest_ts", F.lit("2024-01-01").cast("timestamp"))
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "stream")
    first = F.col("paperId").cast("long") % 4 == 1
    for sent in (records.where(first), records):
        sent.write.mode("append").options(**PACKED).json(inbox)
        stateful.grow_graph(updates.read_paper_stream(spark, inbox), known, out, f"{out}/progress", citations)
    return _rounded(citation_edges(known, citations).unionByName(stateful.read_edges(spark, out)), "weight")


def q_neighborhood_many(spark, d):
    g = _citation_graph(spark, d)
    asked = g.vertices.where(F.col("id").cast("long") % 50 == 0).select(F.col("id").alias("request"), "id")
    return neighborhood_many(g, asked).select("request", "id", "hop")


def q_best_moves(spark, d):
    links = undirected(_citation_graph(spark, d))
    placed = links.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("degree")).withColumn("community", F.col("id"))
    return best_moves(links, placed, []).select("id", "best")


def q_modularity_communities(spark, d):
    """Communities of each year's papers; whether their modularity is at least that of single papers."""
    g = _year_graphs(spark, d)
    positive = Graph(g.vertices, g.edges.where("weight > 0"))
    found = modularity_communities(g, max_levels=2, max_rounds=3).withColumnRenamed("community", "label")
    own = g.vertices.select(GRAPH_ID, "id", F.col("id").alias("label"))
    risen = modularity(positive, found).alias("a").join(
        modularity(positive, own).withColumnRenamed("modularity", "single").alias("b"), GRAPH_ID).select(
        GRAPH_ID, (F.col("modularity") >= F.col("single") - 1e-9).alias("risen"))
    sizes = found.groupBy(GRAPH_ID).agg(F.count(F.lit(1)).alias("n_papers"))
    return sizes.join(risen, GRAPH_ID, "left").select(GRAPH_ID, "n_papers", "risen")


def q_pagerank_push(spark, d):
    """Ranks pushed to a tolerance; whether each fulfils its equation."""
    g = _citation_graph(spark, d)
    positive = Graph(g.vertices, g.edges.where("weight > 0"))
    ranks = push_pagerank(positive, tolerance=1e-3).state
    once = ranks.select(F.col("id").alias("src"), "rank")
    totals = positive.edges.groupBy("src").agg(F.sum("weight").alias("total"))
    inflow = positive.edges.join(totals, "src").join(once, "src").groupBy(F.col("dst").alias("id")).agg(
        F.sum(F.col("rank") * F.col("weight") / F.col("total")).alias("inflow"))
    missing = F.abs(0.15 + 0.85 * F.coalesce("inflow", F.lit(0.0)) - F.col("rank"))
    return ranks.join(inflow, "id", "left").select("id", (missing <= 1e-3 + 1e-9).alias("settled"))


def entry(spark: SparkSession) -> DataFrame:
    """PageRank of the citation graph, the ten best papers."""
    return q_pagerank_top10(spark, "/root/testdata/sf0.001")


def _has_pipeline() -> bool:
    """The subpackage ``llm`` and its pipeline can be taken out; the rest works without them."""
    try:
        importlib.import_module("citeloom.llm.queries")
        importlib.import_module("corpus_pipeline")
    except ImportError:
        return False
    return True


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    if _has_pipeline():
        import corpus_pipeline
        from citeloom.llm.queries import QUERIES

        own |= QUERIES | {"pipeline": corpus_pipeline.run}
    return own


# --- SQL ----------------------------------------------------------------------

_PAPERS = """
papers AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id, string_split(d.text, chr(10))[1] AS title, d.text AS abstract,
         d.source AS venue, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(e.embedding AS DOUBLE[]) AS vector, string_split(d.text, chr(10))[-1] AS tldr
  FROM orders o
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey
  LEFT JOIN embeddings e ON e.vec_id = o.o_orderkey)"""

_CITS = _PAPERS + """,
cits AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS src, CAST(l_partkey AS VARCHAR) AS dst
  FROM lineitem)"""

_EDGES = _CITS + """,
cit_edges AS (
  SELECT c.src, c.dst, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight
  FROM cits c JOIN papers a ON a.id = c.src JOIN papers b ON b.id = c.dst)"""


def _star(seed: str = "SELECT id FROM papers") -> str:
    return _CITS + f""",
seed AS ({seed}),
raw AS (
  SELECT src, dst, 'seed_cite' AS edge_type FROM cits WHERE src <> '{CENTRAL}' AND dst <> '{CENTRAL}'
  UNION ALL SELECT src, dst, 'central_cites' FROM cits WHERE src = '{CENTRAL}'
  UNION ALL SELECT src, dst, 'cites_central' FROM cits WHERE dst = '{CENTRAL}'
  UNION ALL SELECT '{CENTRAL}', id, 'fallback' FROM seed WHERE id <> '{CENTRAL}'
    AND id NOT IN (SELECT dst FROM cits WHERE src = '{CENTRAL}')
    AND id NOT IN (SELECT src FROM cits WHERE dst = '{CENTRAL}')),
star AS (
  SELECT r.src, r.dst, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight, r.edge_type
  FROM raw r JOIN papers a ON a.id = r.src JOIN papers b ON b.id = r.dst
  WHERE r.src IN (SELECT id FROM seed) AND r.dst IN (SELECT id FROM seed))"""


_WORDS = r"list_distinct([x FOR x IN regexp_split_to_array(lower(concat_ws(' ', title, abstract)), '[^\p{L}]+') IF x <> ''])"

_VENUE_YEAR = _PAPERS + """,
grouped AS (
  SELECT concat_ws('|', coalesce(venue, ''), CAST(year AS VARCHAR)) AS graph_id, *
  FROM papers WHERE year IS NOT NULL)"""


def _venue_year_edges(threshold: float) -> str:
    return _VENUE_YEAR + f""",
pairs AS (
  SELECT a.graph_id, a.id AS src, b.id AS dst, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight
  FROM grouped a JOIN grouped b ON a.graph_id = b.graph_id AND a.id < b.id AND a.vector IS NOT NULL AND b.vector IS NOT NULL
  WHERE list_cosine_similarity(a.vector, b.vector) >= {threshold}),
sim AS (
  SELECT graph_id, src, dst, weight FROM pairs UNION ALL SELECT graph_id, dst, src, weight FROM pairs)"""


def _rounds(vertices: str, edges: str, keys: str = "", n: int = 10) -> str:
    """Unrolled PageRank rounds ``r0`` .. ``rn`` as CTEs; ``keys`` is '' or 'graph_id, '."""
    def on(a: str, b: str, x: str, y: str) -> str:
        both = f" AND {a}.graph_id = {b}.graph_id" if keys else ""
        return f"{a}.{x} = {b}.{y}{both}"

    def qualified(t: str) -> str:
        return f"{t}.graph_id, " if keys else ""

    parts = [f"r0 AS (SELECT {keys}id, 1.0::DOUBLE AS rank FROM {vertices})"]
    for i in range(1, n + 1):
        p = f"r{i - 1}"
        parts.append(f"""r{i} AS MATERIALIZED (
  SELECT {qualified('p')}p.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(q.s, 0) AS rank FROM {vertices} p
  LEFT JOIN (SELECT {qualified('e')}e.dst AS id, sum({p}.rank * e.weight) AS s
             FROM {edges} e JOIN {p} ON {on(p, 'e', 'id', 'src')} GROUP BY ALL) q ON {on('q', 'p', 'id', 'id')})""")
    return ",\n".join(parts)


def _links() -> str:
    return _EDGES + """,
links AS (
  SELECT DISTINCT id, other FROM (
    SELECT src AS id, dst AS other FROM cit_edges UNION ALL SELECT dst, src FROM cit_edges))"""


def _hops(start: str, degrees: int) -> str:
    parts = [f"h0 AS ({start})"]
    for i in range(1, degrees + 1):
        parts.append(f"h{i} AS (SELECT DISTINCT l.other AS id FROM h{i - 1} JOIN links l ON l.id = h{i - 1}.id)")
    found = " UNION ALL ".join(f"SELECT id, {i} AS hop FROM h{i}" for i in range(degrees + 1))
    return f"""{_links()},
{', '.join(parts)},
found AS (SELECT id, CAST(min(hop) AS INTEGER) AS hop FROM ({found}) GROUP BY id)
SELECT p.id, f.hop FROM papers p LEFT JOIN found f ON f.id = p.id"""


def _on(a: str, x: str, b: str, z: str, keys: str) -> str:
    return f"{a}.{x} = {b}.{z}" + (f" AND {a}.graph_id = {b}.graph_id" if keys else "")


def _label_parts(n: int, vertices: str, edges: str, keys: str = "") -> str:
    """Unrolled rounds of neighbour votes as CTEs ``l0`` .. ``ln``."""
    own = "p.graph_id, " if keys else ""
    parts = [f"""votes_on AS (
  SELECT {keys}src, dst, CAST(weight AS DECIMAL(28,9)) AS vote FROM {edges} WHERE src <> dst
  UNION ALL SELECT {keys}dst, src, CAST(weight AS DECIMAL(28,9)) FROM {edges} WHERE src <> dst)""",
             f"l0 AS (SELECT {keys}id, id AS label FROM {vertices})"]
    for i in range(1, n + 1):
        p, v = f"l{i - 1}", "v.graph_id, " if keys else ""
        parts.append(f"""l{i} AS MATERIALIZED (
  SELECT {own}p.id, coalesce(b.label, p.label) AS label FROM {p} p LEFT JOIN (
    SELECT {keys}id, label FROM (
      SELECT {v}v.dst AS id, x.label, row_number() OVER (
        PARTITION BY {v}v.dst ORDER BY sum(v.vote) DESC, x.label) AS place
      FROM votes_on v JOIN {p} x ON {_on("x", "id", "v", "src", keys)} GROUP BY {v}v.dst, x.label)
    WHERE place = 1) b ON {_on("b", "id", "p", "id", keys)})""")
    return ",\n".join(parts)


def _label_rounds(n: int) -> str:
    return f"{_EDGES.strip()},\n{_label_parts(n, 'papers', 'cit_edges')}"


def _min_rounds(vertices: str, links: str, keys: str = "", n: int = 16) -> str:
    """Unrolled rounds in which every vertex takes the smallest label around it; enough for the test graphs."""
    own = "p.graph_id, " if keys else ""
    parts = [f"m0 AS (SELECT {keys}id, id AS component FROM {vertices})"]
    for i in range(1, n + 1):
        p = f"m{i - 1}"
        parts.append(f"""m{i} AS MATERIALIZED (
  SELECT {own}p.id, least(p.component, coalesce(min(x.component), p.component)) AS component FROM {p} p
  LEFT JOIN {links} l ON {_on("l", "id", "p", "id", keys)} LEFT JOIN {p} x ON {_on("x", "id", "l", "other", keys)}
  GROUP BY {own}p.id, p.component)""")
    return ",\n".join(parts)


_YEARS = _CITS + """,
y AS (SELECT CAST(year AS VARCHAR) AS graph_id, * FROM papers WHERE year IS NOT NULL),
yedges AS (
  SELECT a.graph_id, c.src, c.dst, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight
  FROM cits c JOIN y a ON a.id = c.src JOIN y b ON b.id = c.dst AND b.graph_id = a.graph_id)"""


def _graph_stars(members: str, centres: str) -> str:
    """``gstar``: a star for each graph that has a centre, citation edges for the others."""
    return f"""
within AS (SELECT a.graph_id, k.src, k.dst FROM cits k JOIN {members} a ON a.id = k.src
           JOIN {members} b ON b.id = k.dst AND b.graph_id = a.graph_id),
graw AS (
  SELECT w.graph_id, w.src, w.dst, CASE WHEN z.c IS NULL THEN 'citation' ELSE 'seed_cite' END AS edge_type
  FROM within w LEFT JOIN {centres} z ON z.graph_id = w.graph_id WHERE z.c IS NULL OR (w.src <> z.c AND w.dst <> z.c)
  UNION ALL SELECT z.graph_id, w.src, w.dst, 'central_cites' FROM within w JOIN {centres} z ON z.graph_id = w.graph_id AND w.src = z.c
  UNION ALL SELECT z.graph_id, w.src, w.dst, 'cites_central' FROM within w JOIN {centres} z ON z.graph_id = w.graph_id AND w.dst = z.c
  UNION ALL SELECT z.graph_id, z.c, a.id, 'fallback' FROM {members} a JOIN {centres} z ON z.graph_id = a.graph_id WHERE a.id <> z.c
    AND NOT EXISTS (SELECT 1 FROM cits k WHERE k.src = z.c AND k.dst = a.id)
    AND NOT EXISTS (SELECT 1 FROM cits k WHERE k.dst = z.c AND k.src = a.id)),
gstar AS (
  SELECT r.graph_id, r.src, r.dst, r.edge_type, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight
  FROM graw r JOIN papers a ON a.id = r.src JOIN papers b ON b.id = r.dst)"""


_HIT_WORDS = "['" + "', '".join(KEYWORDS) + "']"
_TOP_CITATION = f"{_EDGES},\n{_rounds('papers', 'cit_edges')}"
_TOP_VENUE = f"{_venue_year_edges(MIN_SIMILARITY)},\n{_rounds('grouped', 'sim', 'graph_id, ')}"


def _many_hits(asked: str) -> str:
    return f"""{_CITS},
asked(graph_id, terms) AS (VALUES {asked}),
hits AS (
  SELECT a.graph_id, p.id, CAST(len(list_intersect({_WORDS}, a.terms)) AS INTEGER) AS score
  FROM papers p, asked a)"""


_ASKED = f"('g1', ['tion']), ('g2', {_HIT_WORDS}), ('g3', ['the', 'tion'])"


def _top_hits(terms: list[str], limit: int, offset: int) -> str:
    return f"""WITH {_PAPERS},
hits AS (SELECT id, CAST(len(list_intersect({_WORDS}, {terms})) AS INTEGER) AS score FROM papers)
SELECT id, score FROM hits WHERE score > 0 ORDER BY score DESC, id LIMIT {limit} OFFSET {offset}"""


def oracle_sql() -> dict[str, str]:
    keyword_seed = (
        f"SELECT id FROM papers WHERE len(list_intersect({_WORDS}, {_HIT_WORDS})) > 0 OR id = '{CENTRAL}'")
    one_hop = f"""{_EDGES},
seeds AS (SELECT id FROM papers WHERE id IN ('{"', '".join(SEEDS)}')),
member AS (SELECT id FROM seeds UNION SELECT c.dst FROM cits c JOIN seeds s ON s.id = c.src)"""
    own = {
        "explode_references": f"WITH {_CITS} SELECT src, dst FROM cits",
        "dedup_papers": f"""WITH {_CITS},
refs AS (SELECT src, count(*) AS n FROM cits GROUP BY src),
base AS (SELECT p.id, p.title, 1 AS has_vector, r.n AS n FROM papers p LEFT JOIN refs r ON r.src = p.id),
copies AS (
  SELECT * FROM base
  UNION ALL SELECT id, 'AA' || title, 0, n FROM base
  UNION ALL SELECT id, 'zz' || title, 1, NULL FROM base)
SELECT id, title, CAST(has_vector AS INTEGER) AS has_vector, CAST(coalesce(n, 0) AS INTEGER) AS n_references
FROM (SELECT *, row_number() OVER (
        PARTITION BY id ORDER BY has_vector DESC, n IS NULL, title NULLS FIRST) AS place FROM copies)
WHERE place = 1""",
        "vertices_keyword": f"""WITH {_PAPERS},
wrote AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS a, s_name
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey),
names AS (SELECT id, string_agg(s_name, ',' ORDER BY a, s_name) AS author_names FROM wrote GROUP BY id)
SELECT p.id, title, year, md5(abstract) AS abstract_md5, CAST(len(vector) AS INTEGER) AS n_dims,
       round(list_sum(vector), 6) AS vector_sum, n.author_names, tldr
FROM papers p LEFT JOIN names n ON n.id = p.id""",
        "keyword_search": f"""WITH {_PAPERS}
SELECT id, title, CAST(len(list_intersect({_WORDS}, {_HIT_WORDS})) AS INTEGER) AS score FROM papers
WHERE len(list_intersect({_WORDS}, {_HIT_WORDS})) > 0""",
        "search_page": f"""WITH {_PAPERS}
SELECT id, CAST(1 AS INTEGER) AS score FROM papers WHERE list_contains({_WORDS}, 'the')
ORDER BY id LIMIT 100 OFFSET 50""",
        "search_preview": f"""WITH {_PAPERS},
hits AS (SELECT id, title, year FROM papers WHERE list_contains({_WORDS}, 'tion'))
SELECT CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS position, title, year, id,
       greatest((SELECT count(*) FROM hits) - 5, 0) AS n_more
FROM hits ORDER BY id LIMIT 5""",
        "keyword_search_many": f"""WITH {_many_hits(_ASKED)}
SELECT graph_id, id, score FROM hits WHERE score > 0""",
        "keyword_index_search": f"""WITH {_PAPERS}
SELECT id, CAST(len(list_intersect({_WORDS}, {_HIT_WORDS})) AS INTEGER) AS score FROM papers
WHERE len(list_intersect({_WORDS}, {_HIT_WORDS})) > 0""",
        "keyword_index_top": _top_hits(["the", "tion", *KEYWORDS], 40, 10),
        "keyword_index_many": f"""WITH {_many_hits(_ASKED)}
SELECT graph_id, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY graph_id ORDER BY score DESC, id) AS place FROM hits WHERE score > 0) WHERE place <= 30""",
        "keyword_index_update": _top_hits(["the", *KEYWORDS], 100, 0),
        "parse_terms": """
WITH t AS (
  SELECT doc_id, source, n_chars, [y FOR y IN [trim(x, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))
    FOR x IN string_split(text, ',')] IF y <> ''] AS terms
  FROM documents)
SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, md5(array_to_string(terms, ' ')) AS query_md5,
       source || ' ' || CAST(n_chars AS VARCHAR) AS publication_query FROM t""",
        "lookup_ids": f"WITH {_CITS} SELECT id, title FROM papers WHERE id IN (SELECT dst FROM cits)",
        "missing_ids": f"""WITH {_CITS}, spread AS (SELECT DISTINCT CAST(CAST(dst AS BIGINT) * 10 AS VARCHAR) AS id FROM cits)
SELECT id FROM spread WHERE id NOT IN (SELECT id FROM papers)""",
        "publication_search": f"""WITH {_PAPERS}
SELECT id, title, venue, year FROM papers
WHERE year = {YEAR} AND contains(lower(coalesce(venue, '')), lower('{PUBLICATION}'))""",
        "lookup_ids_strict": f"WITH {_PAPERS} SELECT id, title FROM papers WHERE id IN ('{"', '".join(SEEDS)}')",
        "ingest_json": f"""WITH {_CITS},
refs AS (SELECT src, count(*) AS n FROM cits GROUP BY src),
wrote AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
SELECT p.id, title, venue, year, CAST(coalesce(r.n, 0) AS INTEGER) AS n_references,
       CAST(coalesce(w.n, 0) AS INTEGER) AS n_authors, 'fixture' AS model, round(list_sum(vector), 6) AS vector_sum
FROM papers p LEFT JOIN refs r ON r.src = p.id LEFT JOIN wrote w ON w.id = p.id""",
        "parse_json_column": """
SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS title, CAST(NULL AS INTEGER) AS year FROM embeddings
UNION ALL SELECT NULL, NULL, NULL FROM embeddings""",
        "attach_embeddings": f"""WITH {_PAPERS}
SELECT p.id, p.venue, CASE WHEN e.label < 3 THEN CAST(len(p.vector) AS INTEGER) END AS n_dims
FROM papers p LEFT JOIN embeddings e ON CAST(e.vec_id AS VARCHAR) = p.id""",
        "cosine_pairs": f"""WITH {_PAPERS}
SELECT id, round(coalesce(list_cosine_similarity(vector, list_reverse(vector)), 0), 6) AS reversed,
       round(coalesce(list_dot_product(vector[1:32], vector[1:32])
             / (sqrt(list_dot_product(vector, vector)) * sqrt(list_dot_product(vector[1:32], vector[1:32]))), 0), 6) AS prefix,
       round(coalesce(list_cosine_similarity(vector, [-x FOR x IN vector]), 0), 6) AS opposite,
       0.0::DOUBLE AS null_side, 0.0::DOUBLE AS empty_side, 0.0::DOUBLE AS zero_side
FROM papers""",
        "citation_edges": f"WITH {_EDGES} SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges",
        "star_edges": f"WITH {_star()} SELECT src, dst, round(weight, 6) AS weight, edge_type FROM star",
        "star_fallback": f"WITH {_star()} SELECT src, dst, round(weight, 6) AS weight FROM star WHERE edge_type = 'fallback'",
        "star_or_citation": f"""WITH {_EDGES}
SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges""",
        "hub_edges": f"""WITH {_PAPERS}, hub AS (SELECT min(id) AS h FROM papers)
SELECT h AS src, id AS dst, 1.0::DOUBLE AS weight FROM papers, hub WHERE id <> h
UNION ALL SELECT id, h, 1.0::DOUBLE FROM papers, hub WHERE id <> h""",
        "hub_edges_by_venue": f"""WITH {_PAPERS},
hub AS (SELECT venue, min(id) AS h FROM papers GROUP BY venue),
paired AS (SELECT p.venue AS graph_id, h, id FROM papers p JOIN hub USING (venue) WHERE id <> h)
SELECT graph_id, h AS src, id AS dst, 1.0::DOUBLE AS weight FROM paired
UNION ALL SELECT graph_id, id, h, 1.0::DOUBLE FROM paired""",
        "keyword_graph_vertices": f"WITH {_PAPERS} SELECT id, title, year, tldr FROM papers WHERE id IN ({keyword_seed})",
        "keyword_graph_edges": f"WITH {_star(keyword_seed)} SELECT src, dst, round(weight, 6) AS weight, edge_type FROM star",
        "keyword_graphs": f"""WITH {_many_hits(_ASKED)}
SELECT a.graph_id, c.src, c.dst, round(coalesce(list_cosine_similarity(p.vector, q.vector), 0), 6) AS weight, 'citation' AS edge_type
FROM cits c JOIN hits a ON a.id = c.src AND a.score > 0 JOIN hits b ON b.id = c.dst AND b.score > 0 AND a.graph_id = b.graph_id
JOIN papers p ON p.id = c.src JOIN papers q ON q.id = c.dst""",
        "one_hop_vertices": f"WITH {one_hop} SELECT id, title, year FROM papers WHERE id IN (SELECT id FROM member)",
        "one_hop_edges": f"""WITH {one_hop} SELECT src, dst, round(weight, 6) AS weight FROM cit_edges
WHERE src IN (SELECT id FROM member) AND dst IN (SELECT id FROM member)""",
        "one_hop_graphs": f"""WITH {_EDGES},
member AS (
  SELECT venue AS graph_id, id FROM papers WHERE venue IS NOT NULL
  UNION SELECT p.venue, c.dst FROM cits c JOIN papers p ON p.id = c.src WHERE p.venue IS NOT NULL)
SELECT a.graph_id, e.src, e.dst, round(weight, 6) AS weight
FROM cit_edges e JOIN member a ON a.id = e.src JOIN member b ON b.id = e.dst AND a.graph_id = b.graph_id""",
        "similarity_pairs": f"WITH {_venue_year_edges(MIN_SIMILARITY)} SELECT graph_id, src, dst, round(weight, 6) AS weight FROM pairs",
        "similarity_edges": f"WITH {_venue_year_edges(MIN_SIMILARITY)} SELECT graph_id, src, dst, round(weight, 6) AS weight FROM sim",
        "publication_graph_edges": f"""WITH {_PAPERS},
hits AS (SELECT * FROM papers WHERE year = {YEAR} AND contains(lower(coalesce(venue, '')), lower('{PUBLICATION}'))),
pairs AS (
  SELECT a.id AS src, b.id AS dst, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight
  FROM hits a JOIN hits b ON a.id < b.id)
SELECT src, dst, round(weight, 6) AS weight FROM pairs WHERE weight >= {MIN_SIMILARITY}
UNION ALL SELECT dst, src, round(weight, 6) FROM pairs WHERE weight >= {MIN_SIMILARITY}""",
        "publication_graphs": f"""WITH {_PAPERS},
asked(graph_id, publication, asked_year) AS (VALUES ('g1', 'SRC1', 1998), ('g2', 'src7', 1997), ('g3', '', 1996)),
hits AS (SELECT a.graph_id, p.* FROM papers p JOIN asked a
  ON p.year = a.asked_year AND contains(lower(coalesce(p.venue, '')), lower(a.publication))),
pairs AS (
  SELECT a.graph_id, a.id AS src, b.id AS dst, coalesce(list_cosine_similarity(a.vector, b.vector), 0) AS weight
  FROM hits a JOIN hits b ON a.id < b.id AND a.graph_id = b.graph_id)
SELECT graph_id, src, dst, round(weight, 6) AS weight FROM pairs WHERE weight >= {MIN_SIMILARITY}
UNION ALL SELECT graph_id, dst, src, round(weight, 6) FROM pairs WHERE weight >= {MIN_SIMILARITY}""",
        "mixed_graph_edges": f"""WITH {_venue_year_edges(MIN_SIMILARITY)},
{_EDGES.split("AS tldr", 1)[1].split("),", 1)[1]}
SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges
UNION ALL SELECT src, dst, round(weight, 6), 'similarity' FROM sim""",
        "coauthor_edges": """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS src, 'author:' || CAST(l_suppkey AS VARCHAR) AS dst,
       1.0::DOUBLE AS weight, 'authored_by' AS edge_type
FROM lineitem""",
        "venue_edges": f"""WITH {_PAPERS}
SELECT id AS src, 'venue:' || venue || '|' || CAST(year AS VARCHAR) AS dst, 1.0::DOUBLE AS weight,
       'published_in' AS edge_type FROM papers WHERE venue IS NOT NULL AND year IS NOT NULL""",
        "venue_nodes": f"""WITH {_PAPERS}
SELECT 'venue:' || venue || '|' || CAST(year AS VARCHAR) AS id, count(*) AS papers
FROM papers WHERE venue IS NOT NULL AND year IS NOT NULL GROUP BY 1""",
        "related_papers": f"""WITH wrote AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id, l_suppkey AS a FROM lineitem)
SELECT s.id AS src, w.id AS dst, CAST(count(*) AS DOUBLE) AS weight
FROM wrote s JOIN wrote w ON w.a = s.a AND w.id <> s.id WHERE s.id = '{CENTRAL}' GROUP BY ALL""",
        "graph_stats": f"""WITH {_venue_year_edges(MIN_SIMILARITY)},
v AS (SELECT graph_id, count(*) AS n FROM grouped GROUP BY 1),
e AS (SELECT graph_id, count(*) AS n FROM sim GROUP BY 1)
SELECT v.graph_id, v.n AS n_vertices, v.n * (v.n - 1) // 2 AS n_pairs, coalesce(e.n, 0) AS n_edges
FROM v LEFT JOIN e ON e.graph_id = v.graph_id""",
        "pagerank_citation": f"""WITH {_TOP_CITATION}
SELECT r.id, round(r.rank, 6) AS rank, p.title, p.venue, p.year FROM r10 r JOIN papers p ON p.id = r.id""",
        "pagerank_star": f"""WITH {_star()},
{_rounds('papers', 'star')}
SELECT r.id, round(r.rank, 6) AS rank, p.title, p.venue, p.year FROM r10 r JOIN papers p ON p.id = r.id""",
        "pagerank_similarity": f"""WITH {_TOP_VENUE}
SELECT r.graph_id, r.id, round(r.rank, 6) AS rank, p.title, p.venue, p.year
FROM r10 r JOIN grouped p ON p.id = r.id AND p.graph_id = r.graph_id""",
        "pagerank_normalized": f"""WITH {_venue_year_edges(MIN_SIMILARITY)},
totals AS (SELECT graph_id, src, sum(weight) AS total FROM sim GROUP BY ALL),
shared AS (SELECT s.graph_id, s.src, s.dst, s.weight / t.total AS weight
  FROM sim s JOIN totals t ON t.graph_id = s.graph_id AND t.src = s.src),
{_rounds('grouped', 'shared', 'graph_id, ')}
SELECT graph_id, id, round(rank, 6) AS rank FROM r10""",
        "pagerank_top10": f"""WITH {_TOP_CITATION}
SELECT CAST(row_number() OVER (ORDER BY r.rank DESC, r.id) AS INTEGER) AS position, r.id,
       round(r.rank, 6) AS rank, p.title
FROM r10 r JOIN papers p ON p.id = r.id ORDER BY position LIMIT 10""",
        "top_by_graph": f"""WITH {_TOP_VENUE}
SELECT graph_id, CAST(position AS INTEGER) AS position, id, rank FROM (
  SELECT graph_id, id, round(rank, 6) AS rank,
         row_number() OVER (PARTITION BY graph_id ORDER BY round(rank, 6) DESC, id) AS position FROM r10)
WHERE position <= 3""",
        "viz_nodes": f"""WITH {_TOP_CITATION},
placed AS (SELECT p.id, p.title, r.rank, row_number() OVER (ORDER BY r.rank DESC, r.id) AS position,
                  max(r.rank) OVER () AS peak FROM r10 r JOIN papers p ON p.id = r.id)
SELECT id, CASE WHEN position <= 10 THEN title ELSE ' ' END AS label, coalesce(title, '') AS hover,
       CAST(CASE WHEN position <= 10 THEN 20 ELSE 10 END AS INTEGER) AS size,
       round(greatest(rank, 0) / peak * 20, 6) AS size_scaled FROM placed""",
        "viz_nodes_publication": f"""WITH {_TOP_VENUE},
ranked AS (SELECT p.graph_id, p.id, p.title, p.venue, p.year, round(r.rank, 6) AS rank
  FROM r10 r JOIN grouped p ON p.id = r.id AND p.graph_id = r.graph_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY graph_id ORDER BY rank DESC, id) AS position,
                  max(rank) OVER (PARTITION BY graph_id) AS peak FROM ranked)
SELECT graph_id, id, CASE WHEN position <= 3 THEN title ELSE '' END AS label,
       coalesce(title, '') || chr(10) || coalesce(venue, '') || ' (' || coalesce(CAST(year AS VARCHAR), '') || ')' AS hover,
       CAST(CASE WHEN position <= 3 THEN 20 ELSE 10 END AS INTEGER) AS size,
       round(greatest(rank, 0) / peak * 20, 6) AS size_scaled FROM placed""",
        "viz_edges": f"""WITH {_star()}
SELECT src, dst, round(greatest(weight * 5.0, 1.0), 6) AS value, printf('%.3f', weight) AS label,
       CASE WHEN edge_type = 'fallback' THEN 'black' END AS color,
       CASE WHEN edge_type = 'fallback' THEN '' END AS arrows FROM star""",
        "two_hop": f"WITH {_hops(f'''SELECT id FROM papers WHERE id = '{CENTRAL}' ''', 2)}",
        "three_hop": f"""WITH {_hops("SELECT id FROM papers WHERE venue = 'src3'", 3)}""",
        "induced_subgraph": f"""WITH {_EDGES}, chosen AS (SELECT id FROM papers WHERE year IN (1996, 1997, 1998))
SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges
WHERE src IN (SELECT id FROM chosen) AND dst IN (SELECT id FROM chosen)""",
        "filter_nodes_by_prop": f"WITH {_PAPERS} SELECT id FROM papers WHERE year IN (1998, 1999)",
        "filter_edges_by_prop": f"""WITH {_star()}, hit AS (
  SELECT * FROM star WHERE edge_type IN ('cites_central', 'seed_cite'))
SELECT src AS id FROM hit UNION SELECT dst FROM hit""",
        "connected_components": f"""WITH {_links()},
{_min_rounds("papers", "links")}
SELECT id, component FROM m16""",
        "components_by_graph": f"""WITH {_YEARS},
ylinks AS (SELECT graph_id, src AS id, dst AS other FROM yedges UNION SELECT graph_id, dst, src FROM yedges),
{_min_rounds("y", "ylinks", "graph_id, ", 60)}
SELECT graph_id, id, component FROM m60""",
        "labels_by_graph": f"""WITH {_YEARS},
{_label_parts(4, "y", "yedges", "graph_id, ")} SELECT graph_id, id, label FROM l4""",
        "modularity_by_graph": f"""WITH {_YEARS},
tagged AS (SELECT graph_id, weight, CAST(src AS BIGINT) % 3 AS sl, CAST(dst AS BIGINT) % 3 AS dl FROM yedges),
shares AS (
  SELECT graph_id, sl AS label, weight AS degree, CASE WHEN sl = dl THEN weight ELSE 0 END AS inside FROM tagged
  UNION ALL SELECT graph_id, dl, weight, 0 FROM tagged),
g AS (SELECT graph_id, label, sum(degree) AS degree, sum(inside) AS inside FROM shares GROUP BY ALL)
SELECT graph_id, round(sum(inside) / nullif(sum(degree) / 2, 0)
       - sum(degree * degree) / nullif(sum(degree) * sum(degree), 0), 6) AS modularity FROM g GROUP BY graph_id""",
        "star_edges_by_graph": f"""WITH {_YEARS},
yc AS (SELECT graph_id, min(id) AS c FROM y WHERE vector IS NOT NULL GROUP BY 1),
{_graph_stars("y", "yc")}
SELECT graph_id, src, dst, round(weight, 6) AS weight, edge_type FROM gstar""",
        "keyword_star_graphs": f"""WITH {_many_hits(_ASKED)},
centre(graph_id, c) AS (VALUES ('g1', '{CENTRAL}')),
member AS (
  SELECT h.graph_id, p.* FROM papers p JOIN (
    SELECT graph_id, id FROM hits WHERE score > 0 UNION SELECT graph_id, c FROM centre) h ON h.id = p.id),
{_graph_stars("member", "centre")}
SELECT graph_id, src, dst, round(weight, 6) AS weight, edge_type FROM gstar""",
        "star_of_known_paper": f"WITH {_star()} SELECT src, dst, round(weight, 6) AS weight, edge_type FROM star",
        "unique_vertices": f"WITH {_PAPERS} SELECT id, year FROM papers",
        "pagerank_citation_normalized": f"""WITH {_EDGES},
close AS (SELECT * FROM cit_edges WHERE weight >= {CLOSE}),
totals AS (SELECT src, sum(weight) AS total FROM close GROUP BY 1),
shared AS (SELECT e.src, e.dst, e.weight / t.total AS weight FROM close e JOIN totals t ON t.src = e.src),
{_rounds('papers', 'shared')}
SELECT id, round(rank, 6) AS rank FROM r10""",
        "pagerank_salted": f"""WITH {_star()},
{_rounds('papers', 'star')}
SELECT id, round(rank, 6) AS rank FROM r10""",
        "streaming_new_papers": f"""WITH {_EDGES}
SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges""",
        "streaming_state_edges": f"""WITH {_EDGES}
SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges""",
        "neighborhood_many": f"""WITH {_CITS},
known AS (SELECT src, dst FROM cits WHERE src IN (SELECT id FROM papers) AND dst IN (SELECT id FROM papers)),
links AS (SELECT src, dst FROM known UNION SELECT dst, src FROM known),
r0 AS (SELECT id AS request, id, 0 AS hop FROM papers WHERE CAST(id AS BIGINT) % 50 = 0),
r1 AS (SELECT DISTINCT request, l.dst AS id, 1 AS hop FROM r0 JOIN links l ON l.src = r0.id),
r2 AS (SELECT DISTINCT request, l.dst AS id, 2 AS hop FROM r1 JOIN links l ON l.src = r1.id)
SELECT request, id, CAST(min(hop) AS INTEGER) AS hop
FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2) GROUP BY request, id""",
        "best_moves": f"""WITH {_EDGES},
pos AS (SELECT src, dst, CAST(weight AS DECIMAL(28, 9)) AS weight FROM cit_edges WHERE weight > 0),
links AS (SELECT src, dst, sum(weight) AS weight FROM (
  SELECT src, dst, weight FROM pos UNION ALL SELECT dst, src, weight FROM pos) GROUP BY src, dst),
deg AS (SELECT src AS id, CAST(sum(weight) AS DOUBLE) AS degree FROM links GROUP BY src),
m AS (SELECT CAST(sum(weight) AS DOUBLE) AS m2 FROM links),
options AS (SELECT src AS id, dst AS target, CAST(weight AS DOUBLE) AS inside FROM links WHERE src <> dst
            UNION ALL SELECT id, id, 0.0 FROM deg),
worth AS (
  SELECT o.id, o.target, o.id = o.target AS stays,
         round(o.inside - a.degree * CASE WHEN o.id = o.target THEN 0.0 ELSE b.degree END / m2, 9) AS worth
  FROM options o JOIN deg a ON a.id = o.id JOIN deg b ON b.id = o.target, m)
SELECT id, target AS best FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY worth DESC, stays DESC, target) AS place FROM worth) WHERE place = 1""",
        "modularity_communities": f"""WITH {_YEARS},
linked AS (SELECT DISTINCT graph_id FROM yedges WHERE weight > 0)
SELECT p.graph_id, count(*) AS n_papers, CASE WHEN max(l.graph_id) IS NOT NULL THEN true END AS risen
FROM y p LEFT JOIN linked l ON l.graph_id = p.graph_id GROUP BY p.graph_id""",
        "pagerank_push": f"WITH {_PAPERS} SELECT id, true AS settled FROM papers",
        "label_propagation": f"WITH {_label_rounds(4)} SELECT id, label FROM l4",
        "modularity": f"""WITH {_EDGES},
tagged AS (SELECT e.weight, coalesce(a.venue, '') AS sl, coalesce(b.venue, '') AS dl
  FROM cit_edges e JOIN papers a ON a.id = e.src JOIN papers b ON b.id = e.dst),
shares AS (
  SELECT sl AS label, weight AS degree, CASE WHEN sl = dl THEN weight ELSE 0 END AS inside FROM tagged
  UNION ALL SELECT dl, weight, 0 FROM tagged),
g AS (SELECT label, sum(degree) AS degree, sum(inside) AS inside FROM shares GROUP BY label)
SELECT round(sum(inside) / (sum(degree) / 2) - sum(degree * degree) / (sum(degree) * sum(degree)), 6) AS modularity FROM g""",
        "roundtrip_vertices": f"WITH {_PAPERS} SELECT id, title, year FROM papers",
        "roundtrip_edges": f"WITH {_EDGES} SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges",
        "load_year_pruned": f"WITH {_PAPERS} SELECT id, title, year FROM papers WHERE year = {YEAR}",
        "streaming_dedup_edges": f"""WITH {_EDGES}
SELECT src, dst, round(weight, 6) AS weight, 'citation' AS edge_type FROM cit_edges""",
    }
    if _has_pipeline():
        import corpus_pipeline
        from citeloom.llm.queries import ORACLE_SQL

        own |= ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return own
