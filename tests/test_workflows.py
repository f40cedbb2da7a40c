from __future__ import annotations

import json

import pytest

from citeloom.operators.rank import pagerank
from citeloom.operators.report import viz_edges, viz_nodes
from citeloom.plans import workflows as flows
from citeloom.sources import records
from citeloom.storage import cut_lineage, scratch_path, shared_dir
from citeloom.streaming import updates

RECORDS = [
    ("a", "Graph one", "V", 2020, ["b", "c", "zz"], [1.0, 0.0]),
    ("b", "Graph two", "V", 2020, ["a"], [1.0, 1.0]),
    ("c", "Other", "v two", 2020, [], [0.0, 1.0]),
    ("d", "Graph four", "W", 2019, ["a", "d"], None),
]


def as_json(row, **more):
    paper, title, venue, year, refs, vector = row
    out = {"paperId": paper, "title": title, "abstract": "", "venue": venue, "year": year,
           "references": [{"paperId": r} for r in refs], **more}
    if vector is not None:
        out["embedding"] = {"model": "m", "vector": vector}
    return json.dumps(out)


@pytest.fixture
def corpus(spark):
    lines = spark.createDataFrame([(as_json(r),) for r in RECORDS], "value string")
    return records.corpus_from_records(records.parse_json(lines))


def pairs(df):
    return sorted((r.src, r.dst) for r in df.collect())


def ids(df):
    return sorted(r.id for r in df.collect())


def test_keyword_graph_without_centre(corpus):
    g = flows.keyword_graph(corpus, "graph")
    assert ids(g.vertices) == ["a", "b", "d"]
    assert pairs(g.edges) == [("a", "b"), ("b", "a"), ("d", "a"), ("d", "d")]
    assert {r.edge_type for r in g.edges.collect()} == {"citation"}


def test_keyword_graph_adds_the_central_paper(spark, corpus):
    g = flows.keyword_graph(corpus, "graph", central="c")
    assert ids(g.vertices) == ["a", "b", "c", "d"]
    kinds = {(r.src, r.dst): r.edge_type for r in g.edges.collect()}
    assert kinds[("a", "c")] == "cites_central" and kinds[("c", "b")] == kinds[("c", "d")] == "fallback"
    aliases = spark.createDataFrame([("ARXIV:1", "c")], "alias string, paperId string")
    named = flows.keyword_graph(corpus, "graph", central="ARXIV:1", aliases=aliases)
    assert pairs(named.edges) == pairs(g.edges)


def test_unknown_centre_gives_citation_edges(corpus):
    g = flows.keyword_graph(corpus, "graph", central="nowhere")
    assert {r.edge_type for r in g.edges.collect()} == {"citation"}


def test_nothing_found_gives_an_empty_graph(corpus):
    g = flows.keyword_graph(corpus, "absent")
    assert g.vertices.count() == 0 and g.edges.count() == 0
    assert pagerank(g).count() == 0
    assert flows.publication_graph(corpus, "none", 1900).edges.count() == 0


def test_one_hop_graph(spark, corpus):
    g = flows.paper_id_graph(corpus, ["a", "zz"])
    assert ids(g.vertices) == ["a", "b", "c"]
    assert pairs(g.edges) == [("a", "b"), ("a", "c"), ("b", "a")]
    seeds = spark.createDataFrame([("g", "a"), ("g", "zz"), ("h", "d")], "graph_id string, paperId string")
    many = flows.paper_id_graph(corpus, seeds)
    assert sorted((r.graph_id, r.id) for r in many.vertices.collect()) == [
        ("g", "a"), ("g", "b"), ("g", "c"), ("h", "a"), ("h", "d")]
    assert sorted((r.graph_id, r.src, r.dst) for r in many.edges.collect()) == [
        ("g", "a", "b"), ("g", "a", "c"), ("g", "b", "a"), ("h", "d", "a"), ("h", "d", "d")]


def test_publication_graph(corpus):
    g = flows.publication_graph(corpus, "v", 2020)
    assert ids(g.vertices) == ["a", "b", "c"] and "vector" not in g.vertices.columns
    assert len(pairs(g.edges)) == 6
    assert pairs(flows.publication_graph(corpus, "v", 2020, min_similarity=0.5).edges) == [
        ("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")]
    assert flows.publication_graph(corpus, "v", 2020, limit=1).edges.count() == 0


def test_venue_year_graphs(corpus):
    g = flows.venue_year_graphs(corpus)
    assert sorted({r.graph_id for r in g.vertices.collect()}) == ["V|2020", "W|2019", "v two|2020"]
    assert pairs(g.edges) == [("a", "b"), ("b", "a")]


def test_whole_workflow_to_display_tables(corpus):
    g = flows.keyword_graph(corpus, "graph", central="a")
    nodes = viz_nodes(pagerank(g))
    assert nodes.count() == 3
    assert viz_edges(g.edges).count() == g.edges.count()


def test_keyword_star_graphs(spark, corpus):
    asked = spark.createDataFrame([("g", "graph", "c"), ("h", "graph", "nowhere"), ("k", "other", None)],
                                  "graph_id string, keywords string, central string")
    g = flows.keyword_graphs(corpus, asked)
    alone = flows.keyword_graph(corpus, "graph", central="c")
    kinds = {}
    for r in g.edges.collect():
        kinds.setdefault(r.graph_id, []).append((r.src, r.dst, r.edge_type))
    assert sorted(kinds["g"]) == sorted((r.src, r.dst, r.edge_type) for r in alone.edges.collect())
    assert {k for _, _, k in kinds["h"]} == {"citation"} and "k" not in kinds


@pytest.mark.parametrize("known", [[], ["a", "c"], ["a", "b", "c", "d"]])
def test_stream_equals_batch(spark, tmp_path, corpus, known):
    """From an empty graph, from half of the papers, and from all of them; everything is sent twice."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    stamp = "2024-0{}-01T00:00:00Z"
    for n, row in enumerate(RECORDS):
        again = RECORDS[max(0, n - 1)]
        (inbox / f"{n}.json").write_text("\n".join(
            [as_json(row, ingest_ts=stamp.format(9 - n)), as_json(again, ingest_ts=stamp.format(n + 1)), "null"]))
    vertices = flows.citation_vertices(corpus.papers)
    base = vertices.where(vertices["id"].isin(known))
    cited = corpus.citations.where(corpus.citations["src"].isin(known))
    for _ in range(2):
        stream = updates.read_paper_stream(spark, str(inbox), max_files=1)
        updates.append_papers(stream, base, f"{tmp_path}/out", f"{tmp_path}/progress", cited).awaitTermination()
    added = updates.read_appended_edges(spark, f"{tmp_path}/out")
    got = flows.citation_edges(base, cited).unionByName(added)
    batch = flows.citation_edges(vertices, corpus.citations)
    key = lambda r: (r.src, r.dst, r.weight)
    assert sorted(map(key, got.collect())) == sorted(map(key, batch.collect())) and got.columns == batch.columns
    assert ids(updates.read_appended_vertices(spark, f"{tmp_path}/out")) == sorted({"a", "b", "c", "d"} - set(known))


def test_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    df = cut_lineage(spark.range(3))
    assert df.count() == 3 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
