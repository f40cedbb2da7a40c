"""Modularity communities against planted groups, a naive optimum and the direct formula."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from citeloom.operators.community import label_propagation, modularity
from citeloom.operators.moving import TOLERANCE, best_moves, modularity_communities, undirected
from citeloom.schema import Graph


def graph_of(spark, edges, extra=(), graph_id=False):
    schema = ("graph_id string, " if graph_id else "") + "src string, dst string, weight double"
    ids = {(e[0], x) if graph_id else (x,) for e in edges for x in e[graph_id : graph_id + 2]} | set(extra)
    vertices = spark.createDataFrame(sorted(ids), ("graph_id string, " if graph_id else "") + "id string")
    return Graph(vertices, spark.createDataFrame(edges, schema))


def planted(seed, groups, size, inner, outer):
    rng = random.Random(seed)
    names = [(g, f"{g}-{i:02d}") for g in range(groups) for i in range(size)]
    return [(a, b, 1.0) for (g, a), (h, b) in itertools.combinations(names, 2) if rng.random() < (inner if g == h else outer)]


def quality(edges, label):
    m2 = 2 * sum(w for *_, w in edges)
    degree, inside = {}, 0.0
    for a, b, w in edges:
        degree[label[a]] = degree.get(label[a], 0) + w
        degree[label[b]] = degree.get(label[b], 0) + w
        inside += 2 * w * (label[a] == label[b])
    return inside / m2 - sum((d / m2) ** 2 for d in degree.values())


def test_planted_groups_nearly_reached_and_label_propagation_beaten(spark):
    """Local moving ends in a local optimum: within a tenth of the planted groups' modularity."""
    edges = planted(1, 5, 12, 0.5, 0.06)
    g = graph_of(spark, edges, [("alone",)])
    history = []
    found = {r.id: r.community for r in modularity_communities(g, history=history).collect()}
    assert found.pop("alone") == "alone"
    q = quality(edges, found)
    assert q >= 0.9 * quality(edges, {i: i[0] for i in found})
    spread = label_propagation(g)
    assert q >= modularity(g, spread).first()[0] - 1e-9
    named = g.vertices.join(spark.createDataFrame(list(found.items()) + [("alone", "alone")], "id string, label string"), "id")
    assert q == pytest.approx(modularity(g, named).first()[0])
    values = [h[()] for h in history]
    assert all(b >= a - 1e-12 for a, b in zip(values, values[1:], strict=False)) and values[-1] == pytest.approx(q)
    for community in set(found.values()):
        assert community == min(i for i in found if found[i] == community)


def test_small_graphs_reach_the_optimum(spark):
    """Two cliques with a bridge, a ring, a star, loops and repeats, weights that don't count; all at once."""
    clique = lambda names: [(a, b, 1.0) for a, b in itertools.combinations(names, 2)]
    graphs = {
        "cliques": clique("abcd") + clique("efgh") + [("d", "e", 1.0)],
        "weights": [("a", "b", 5.0), ("b", "c", 0.1), ("c", "d", 5.0), ("a", "d", -3.0), ("b", "d", 0.0)],
        "loops": [("a", "a", 2.0), ("a", "b", 1.0), ("b", "a", 1.0), ("c", "d", 3.0), ("b", "c", 0.5)],
        "pair": [("x", "y", 1.0)],
    }
    rows = [(name, *e) for name, edges in graphs.items() for e in edges]
    found = {}
    for r in modularity_communities(graph_of(spark, rows, graph_id=True)).collect():
        found.setdefault(r.graph_id, {})[r.id] = r.community
    for name, edges in graphs.items():
        positive = [e for e in edges if e[2] > 0]
        ids = sorted(found[name])
        best = max(quality(positive, dict(zip(ids, labels, strict=True))) for labels in itertools.product(range(min(len(ids), 3)), repeat=len(ids)))
        assert quality(positive, found[name]) == pytest.approx(best, abs=1e-9), name


def test_best_moves_against_the_change_of_the_formula(spark):
    rng = random.Random(3)
    edges = [(str(rng.randrange(12)), str(rng.randrange(12)), round(rng.random(), 3) + 0.1) for _ in range(40)]
    g = graph_of(spark, edges)
    label = {r.id: str(int(r.id) % 4) for r in g.vertices.collect()}
    links = undirected(g)
    placed = links.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("degree")).withColumn(
        "community", F.pmod(F.col("id").cast("int"), F.lit(4)).cast("string"))
    base = quality(edges, label)
    for r in best_moves(links, placed, []).collect():
        gains = {c: quality(edges, label | {r.id: c}) - base for c in set(label.values())}
        assert r.gain == pytest.approx(gains[r.best], abs=1e-7)
        around = {label[b if a == r.id else a] for a, b, _ in edges if r.id in (a, b)} | {label[r.id]}
        assert r.gain >= max(gains[c] for c in around) - 1e-7


def test_bad_moves_together_are_taken_back(spark):
    """Modularity never falls, also where all neighbours of a hub want the same place at once."""
    edges = [("hub", f"l{i:02d}", 1.0) for i in range(30)] + [(f"l{i:02d}", f"l{(i + 1) % 30:02d}", 1.0) for i in range(30)]
    history = []
    modularity_communities(graph_of(spark, edges), history=history)
    values = [h[()] for h in history]
    assert all(b >= a - 1e-12 for a, b in zip(values, values[1:], strict=False)) and values[-1] > TOLERANCE


def test_no_links(spark):
    g = graph_of(spark, [("a", "b", -1.0)], [("c",)])
    assert {(r.id, r.community) for r in modularity_communities(g).collect()} == {("a", "a"), ("b", "b"), ("c", "c")}
