from __future__ import annotations

import random
from collections import defaultdict

import pytest

from citeloom import Corpus, Graph, storage
from citeloom.operators.community import connected_components, label_propagation, modularity
from citeloom.operators.hetero import coauthor_edges, hub_nodes, related_papers, venue_edges
from citeloom.operators.neighborhood import (
    induced_subgraph,
    neighborhood,
    neighborhood_many,
    nodes_by_edge_property,
    nodes_by_property,
)


@pytest.fixture
def graph(spark):
    def build(ids, pairs):
        v = spark.createDataFrame([(i,) for i in ids], "id string")
        rows = [(s, d, 1.0) for s, d in pairs]
        return Graph(v, spark.createDataFrame(rows, "src string, dst string, weight double"))

    return build


def random_pairs(seed, ids, n):
    rng = random.Random(seed)
    return sorted({(rng.choice(ids), rng.choice(ids)) for _ in range(n)})


def links(pairs):
    out = defaultdict(set)
    for s, d in pairs:
        out[s].add(d)
        out[d].add(s)
    return out


def walk(pairs, start, degrees):
    near, hop = links(pairs), dict.fromkeys(start, 0)
    frontier = set(start)
    for n in range(1, degrees + 1):
        frontier = {o for i in frontier for o in near[i]} - set(hop)
        hop |= dict.fromkeys(frontier, n)
    return hop


@pytest.mark.parametrize("degrees", [2, 3])
def test_neighborhood_is_breadth_first(graph, degrees):
    ids = [f"p{i}" for i in range(40)]
    pairs = random_pairs(3, ids, 45) + [("p0", i) for i in ids[1:6]]
    rows = neighborhood(graph(ids, pairs), ["p0", "p7"], degrees).collect()
    hop = walk(pairs, ["p0", "p7"], degrees)
    assert {r.id: r.hop for r in rows} == {i: hop.get(i) for i in ids}


def test_neighborhood_of_an_unknown_vertex(graph):
    assert {r.hop for r in neighborhood(graph("ab", [("a", "b")]), ["zz"]).collect()} == {None}


def test_induced_subgraph(spark, graph):
    g = graph("abcd", [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d")])
    for chosen in (["a", "b", "zz"], spark.createDataFrame([("a",), ("b",), ("zz",)], "id string")):
        small = induced_subgraph(g, chosen)
        assert {r.id for r in small.vertices.collect()} == {"a", "b"}
        assert [(r.src, r.dst) for r in small.edges.collect()] == [("a", "b")]


def test_selection_by_property(spark):
    v = spark.createDataFrame(
        [("a", 2020, 1.5, "x", True), ("b", 0, 0.0, "", False), ("c", None, 5.0, None, None)],
        "id string, year int, score double, name string, flag boolean")
    pick = lambda *a: sorted(r.id for r in nodes_by_property(v, *a).collect())
    assert pick("year", ["2020", "0"]) == ["a"]
    assert pick("score", ["1.5", "0", "0.0", "5"]) == ["a", "c"]
    assert pick("name", ["x", ""]) == ["a"]
    assert pick("flag", ["true", "false"]) == ["a"]
    e = spark.createDataFrame([("a", "b", "k"), ("b", "c", "k"), ("x", "y", "m")], "src string, dst string, edge_type string")
    assert sorted(r.id for r in nodes_by_edge_property(e, "edge_type", ["k"]).collect()) == ["a", "b", "c"]


def test_components(graph):
    ids = [f"p{i:02d}" for i in range(50)]
    pairs = random_pairs(11, ids, 35) + [(ids[i], ids[i + 1]) for i in range(20, 32)]
    near, want = links(pairs), {}
    for i in ids:
        if i not in want:
            group, todo = {i}, [i]
            while todo:
                fresh = near[todo.pop()] - group
                group |= fresh
                todo += fresh
            want |= dict.fromkeys(group, min(group))
    got = connected_components(graph(ids, pairs))
    assert {r.id: r.component for r in got.collect()} == want


def test_components_without_edges(graph):
    assert {tuple(r) for r in connected_components(graph("ab", [("a", "a")])).collect()} == {("a", "a"), ("b", "b")}


@pytest.mark.parametrize("hot_floor", [10**6, 2])
def test_label_propagation(graph, hot_floor):
    ids = [f"p{i:02d}" for i in range(30)]
    pairs = random_pairs(5, ids, 60)
    labels = {i: i for i in ids}
    for _ in range(3):
        votes = defaultdict(lambda: defaultdict(int))
        for s, d in pairs:
            if s != d:
                votes[d][labels[s]] += 1
                votes[s][labels[d]] += 1
        labels = {i: min(votes[i].items(), key=lambda kv: (-kv[1], kv[0]))[0] if votes[i] else labels[i] for i in ids}
    got = label_propagation(graph(ids, pairs), rounds=3, hot_floor=hot_floor)
    assert {r.id: r.label for r in got.collect()} == labels


def test_modularity(spark, graph):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), ("e", "f"), ("f", "d"), ("c", "d")]
    labels = spark.createDataFrame([(i, "x" if i < "d" else "y") for i in "abcdef"], "id string, label string")
    got = modularity(graph("abcdef", pairs), labels).first().modularity
    assert got == pytest.approx(6 / 7 - 2 * (7 / 14) ** 2)


@pytest.fixture
def two_graphs(spark):
    """One id, ``b``, in two graphs."""
    v = spark.createDataFrame([("g1", "a"), ("g1", "b"), ("g2", "b"), ("g2", "c"), ("g3", "d")], "graph_id string, id string")
    e = spark.createDataFrame([("g1", "a", "b", 1.0), ("g2", "b", "c", 2.0)], "graph_id string, src string, dst string, weight double")
    return Graph(v, e)


def test_communities_keep_graphs_apart(spark, two_graphs):
    found = connected_components(two_graphs)
    assert sorted(map(tuple, found.collect())) == [
        ("g1", "a", "a"), ("g1", "b", "a"), ("g2", "b", "b"), ("g2", "c", "b"), ("g3", "d", "d")]
    found = label_propagation(two_graphs, rounds=1)
    assert sorted(map(tuple, found.collect())) == [
        ("g1", "a", "b"), ("g1", "b", "a"), ("g2", "b", "c"), ("g2", "c", "b"), ("g3", "d", "d")]
    labels = two_graphs.vertices.withColumn("label", two_graphs.vertices["graph_id"] == "g1")
    score = {r.graph_id: r.modularity for r in modularity(two_graphs, labels).collect()}
    assert score == pytest.approx({"g1": 0.0, "g2": 0.0})


def test_long_lists_of_ids_are_joined(graph):
    g = graph("abc", [("a", "b"), ("b", "c")])
    many = ["a", "b", *map(str, range(2000))]
    assert [(r.src, r.dst) for r in induced_subgraph(g, many).edges.collect()] == [("a", "b")]
    assert {r.id: r.hop for r in neighborhood(g, many, 1).collect()} == {"a": 0, "b": 0, "c": 1}


def test_author_and_venue_edges(spark):
    papers = spark.createDataFrame([("p", "V", 2020), ("q", "V", 2020), ("r", None, 2020)],
                                   "paperId string, venue string, year int")
    wrote = spark.createDataFrame([("p", "1", "n"), ("p", "2", "m"), ("q", "1", "n"), ("q", "2", "m"), ("r", "3", "k")],
                                  "paperId string, authorId string, name string")
    corpus = Corpus(papers, None, wrote)
    edges = coauthor_edges(corpus)
    assert edges.count() == 5 and edges.first().dst.startswith("author:")
    assert sorted((r.id, r.papers) for r in hub_nodes(venue_edges(corpus)).collect()) == [("venue:V|2020", 2)]
    chosen = spark.createDataFrame([("p",)], "id string")
    assert [tuple(r) for r in related_papers(edges, chosen).collect()] == [("p", "q", 2.0)]


@pytest.mark.parametrize("keyed", [False, True])
def test_many_neighbourhoods_in_one_traversal(spark, keyed):
    """More requests than one mask has bits, several chosen vertices each, some unknown or null."""
    rng = random.Random(4)
    graphs = ["g", "h"] if keyed else [None]
    prefix = "graph_id string, " if keyed else ""
    row = lambda g, *x: (g, *x) if keyed else x
    vertices = spark.createDataFrame([row(g, f"v{i}") for g in graphs for i in range(40)], prefix + "id string")
    edges = spark.createDataFrame(
        [row(g, f"v{rng.randrange(40)}", f"v{rng.randrange(42)}", 1.0) for g in graphs for _ in range(45)], prefix + "src string, dst string, weight double")
    graph = Graph(vertices, edges)
    wanted = {f"r{k}": sorted({f"v{rng.randrange(41)}" for _ in range(rng.randint(1, 3))}) for k in range(150)}
    rows = [(r, v) for r, chosen in wanted.items() for v in chosen] + [(None, "v1"), ("r0", None), ("r1", wanted["r1"][0])]
    found = {}
    for r in neighborhood_many(graph, spark.createDataFrame(rows, "request string, id string"), degrees=2).collect():
        found.setdefault(r.request, {})[(r.graph_id if keyed else None, r.id)] = r.hop
    around = {}
    for e in edges.collect():
        a, b, g = e.src, e.dst, e.graph_id if keyed else None
        around.setdefault((g, a), set()).add((g, b))
        around.setdefault((g, b), set()).add((g, a))
    known = {(g, f"v{i}") for g in graphs for i in range(40)}
    for request, chosen in wanted.items():
        hops = {(g, v): 0 for g in graphs for v in chosen if (g, v) in known}
        edge = set(hops)
        for hop in (1, 2):
            edge = {y for x in edge for y in around.get(x, ()) if y in known and y not in hops}
            hops |= dict.fromkeys(edge, hop)
        assert found.get(request, {}) == hops
    assert set(found) <= set(wanted)


def test_many_neighbourhoods_shuffle_into_more_tasks_with_the_rows(spark, graph, monkeypatch):
    """The session's number of partitions, whatever the input, made tasks that grew with it."""
    name, used, cut = "spark.sql.shuffle.partitions", [], storage.cut_lineage
    before = spark.conf.get(name)
    monkeypatch.setattr(storage, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(storage, "cut_lineage", lambda df: used.append(int(spark.conf.get(name))) or cut(df))
    ids = [f"v{i}" for i in range(200)]
    asked = spark.createDataFrame([("r", "v0")], "request string, id string")
    found = neighborhood_many(graph(ids, list(zip(ids, ids[1:], strict=False))), asked, degrees=2).collect()
    assert {(r.id, r.hop) for r in found} == {("v0", 0), ("v1", 1), ("v2", 2)}
    # The links, and two rounds that join them; numbering the request is small.
    assert sum(n >= 20 for n in used) >= 4
    assert spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError), storage.shuffled_rows(spark, 1000):
        assert spark.conf.get(name) == "100"
        1 / 0
    assert spark.conf.get(name) == before
