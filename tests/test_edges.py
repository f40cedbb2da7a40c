from __future__ import annotations

import math
import random

import pytest

from citeloom.operators.edges import assert_unique, citation_edges, hub_edges, mixed_edges, star_edges, symmetrize

STAR_CITES = [("c", "c"), ("c", "a"), ("c", "zz"), ("a", "c"), ("a", "a"), ("b", "a")]


def triples(edges):
    return sorted((r.src, r.dst, r.edge_type) for r in edges.collect())


def test_star(vertices, citations):
    v = vertices({"c": [1.0, 0.0], "a": [1.0, 1.0], "b": None, "d": [0.0, 1.0]})
    edges = star_edges(v, citations(STAR_CITES), "c")
    assert triples(edges) == sorted([
        ("a", "a", "seed_cite"), ("b", "a", "seed_cite"), ("a", "c", "cites_central"), ("c", "a", "central_cites"),
        ("c", "c", "central_cites"), ("c", "c", "cites_central"), ("c", "b", "fallback"), ("c", "d", "fallback")])
    weight = {(r.src, r.dst): r.weight for r in edges.collect()}
    assert weight[("c", "a")] == pytest.approx(math.sqrt(0.5))
    assert weight[("c", "c")] == pytest.approx(1.0)
    assert weight[("c", "b")] == weight[("b", "a")] == weight[("c", "d")] == 0.0


def test_star_around_an_id_without_vertex_keeps_ordinary_citations(vertices, citations):
    v = vertices({"c": [1.0], "a": [1.0], "b": [1.0]})
    edges = star_edges(v, citations(STAR_CITES), "ARXIV:1")
    assert triples(edges) == sorted(
        (s, d, "seed_cite") for s, d in [("a", "a"), ("a", "c"), ("b", "a"), ("c", "a"), ("c", "c")])


def test_every_vertex_touches_the_centre(vertices, citations):
    rng = random.Random(1)
    ids = [f"p{i}" for i in range(25)]
    pairs = sorted({(rng.choice(ids), rng.choice(ids)) for _ in range(60)})
    edges = star_edges(vertices(dict.fromkeys(ids, [1.0])), citations(pairs), "p0").collect()
    assert {r.src for r in edges if r.dst == "p0"} | {r.dst for r in edges if r.src == "p0"} >= set(ids) - {"p0"}


def test_min_similarity_is_an_inclusive_filter(vertices, citations):
    v = vertices({"a": [1.0, 0.0], "b": [1.0, 0.0], "c": [-1.0, 0.0], "d": None})
    pairs = citations([("a", "b"), ("a", "c"), ("a", "d")])
    assert len(citation_edges(v, pairs).collect()) == 3
    assert {r.dst for r in citation_edges(v, pairs, 0.0).collect()} == {"b", "d"}
    assert {r.dst for r in citation_edges(v, pairs, 1.0).collect()} == {"b"}


def test_skewed_keys_give_every_pair_once(vertices, citations):
    rng = random.Random(3)
    ids = [f"p{i}" for i in range(40)]
    vectors = {i: [rng.gauss(0, 1) for _ in range(4)] for i in ids}
    pairs = sorted({("p1", i) for i in ids} | {(i, "p2") for i in ids} | {(rng.choice(ids), rng.choice(ids)) for _ in range(80)})
    found = citation_edges(vertices(vectors), citations([*pairs, ("p1", "nowhere"), ("nowhere", "p2")])).collect()
    assert sorted((r.src, r.dst) for r in found) == pairs


def test_graphs_do_not_mix(spark, citations):
    rows = [("g", "a", [1.0]), ("g", "b", [1.0]), ("h", "b", [1.0]), ("h", "c", [1.0])]
    v = spark.createDataFrame(rows, "graph_id string, id string, vector array<double>")
    pairs = citations([("a", "b"), ("b", "c"), ("a", "c")])
    assert sorted((r.graph_id, r.src, r.dst) for r in citation_edges(v, pairs).collect()) == [("g", "a", "b"), ("h", "b", "c")]


def test_a_star_in_each_graph(spark, citations):
    rows = [("g", i, [1.0]) for i in "abc"] + [("h", i, [1.0]) for i in "abd"] + [("k", i, [1.0]) for i in "ab"]
    v = spark.createDataFrame(rows, "graph_id string, id string, vector array<double>")
    centres = spark.createDataFrame([("g", "a"), ("h", "b"), ("k", None)], "graph_id string, id string")
    edges = star_edges(v, citations([("a", "b"), ("b", "c"), ("c", "d")]), centres).collect()
    assert sorted((r.graph_id, r.src, r.dst, r.edge_type) for r in edges) == [
        ("g", "a", "b", "central_cites"), ("g", "a", "c", "fallback"), ("g", "b", "c", "seed_cite"),
        ("h", "a", "b", "cites_central"), ("h", "b", "d", "fallback"), ("k", "a", "b", "citation")]
    one = star_edges(v, citations([("a", "b")]), "a").where("edge_type = 'central_cites'")
    assert sorted(r.graph_id for r in one.collect()) == ["g", "h", "k"]


def test_assert_unique(spark, vertices):
    v = vertices({"a": None, "b": None})
    assert assert_unique(v) is v
    with pytest.raises(ValueError, match="'a'"):
        assert_unique(v.union(v.where("id = 'a'")))
    keyed = spark.createDataFrame([("g", "a"), ("h", "a")], "graph_id string, id string")
    assert assert_unique(keyed).count() == 2


def test_hub(spark, vertices):
    edges = hub_edges(vertices({"b": None, "a": None, "c": None}))
    assert sorted(map(tuple, edges.collect())) == [("a", "b", 1.0), ("a", "c", 1.0), ("b", "a", 1.0), ("c", "a", 1.0)]
    assert hub_edges(vertices({"a": None})).count() == 0
    many = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "x")], "graph_id string, id string")
    assert sorted(map(tuple, hub_edges(many).collect())) == [("g", "a", "b", 1.0), ("g", "b", "a", 1.0)]


def test_symmetrize_and_mix(spark):
    e = spark.createDataFrame([("a", "b", 0.5)], "src string, dst string, weight double")
    both = symmetrize(e)
    assert sorted(map(tuple, both.collect())) == [("a", "b", 0.5), ("b", "a", 0.5)]
    assert sorted(r.edge_type for r in mixed_edges(e, both).collect()) == ["citation", "similarity", "similarity"]
