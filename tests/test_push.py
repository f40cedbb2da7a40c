"""Pushed ranks against full rounds, and their messages."""

from __future__ import annotations

import random

import pytest

from citeloom.operators.push import push_pagerank
from citeloom.operators.rank import pagerank
from citeloom.schema import Graph


def graph_of(spark, edges, ids):
    return Graph(spark.createDataFrame([(i,) for i in sorted(ids)], "id string"),
                 spark.createDataFrame(edges, "src string, dst string, weight double"))


def random_edges(seed, n, m):
    rng = random.Random(seed)
    return sorted({(f"v{rng.randrange(n)}", f"v{int(n * rng.random() ** 3)}"): rng.random() for _ in range(m)}.items())


def flat(items):
    return [(a, b, w) for (a, b), w in items]


def ranks(df):
    return {r.id: r.rank for r in df.collect()}


def full(graph, rounds=60):
    """A dense iteration of the equations."""
    ids = [r.id for r in graph.vertices.collect()]
    edges = graph.edges.collect()
    total = {}
    for e in edges:
        total[e.src] = total.get(e.src, 0.0) + e.weight
    now = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        new = dict.fromkeys(ids, 0.5)
        for e in edges:
            if e.dst in new and e.src in now and total[e.src]:
                new[e.dst] += 0.5 * now[e.src] * e.weight / total[e.src]
        now = new
    return now


def test_equals_full_rounds_with_fewer_messages(spark):
    edges = flat(random_edges(1, 40, 160)) + [("v1", "v2", 0.3), ("v3", "v3", 1.0), ("v4", "v5", 0.0)]
    g = graph_of(spark, edges, {f"v{i}" for i in range(45)})
    pushed = push_pagerank(g, 0.5, tolerance=1e-7)
    found, want = ranks(pushed.state), full(g)
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(want[i], abs=1e-5) for i in want)
    by_rounds = ranks(pagerank(g, 0.5, normalize=True, max_iter=24))
    assert all(found[i] == pytest.approx(by_rounds[i], abs=1e-3) for i in want)
    assert sum(pushed.messages) < 24 * len(edges) and pushed.messages[-1] < pushed.messages[0]


def test_goes_on_after_changes_with_few_messages(spark):
    items = random_edges(2, 60, 240)
    ids = {f"v{i}" for i in range(60)}
    old = graph_of(spark, flat(items), ids)
    first = push_pagerank(old, 0.5, tolerance=1e-7)
    # Some edges go, some come, a new vertex cites and is cited, a vertex leaves.
    changed = [e for e in flat(items)[3:] if "v59" not in e] + [("new", "v1", 1.0), ("v7", "new", 0.5)]
    new = graph_of(spark, changed, (ids | {"new"}) - {"v59"})
    again = push_pagerank(new, 0.5, tolerance=1e-7, before=(first.state, old))
    found, want = ranks(again.state), full(new)
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(want[i], abs=1e-5) for i in want)
    assert sum(again.messages) < sum(push_pagerank(new, 0.5, tolerance=1e-7).messages)
    same = push_pagerank(new, 0.5, tolerance=1e-7, before=(again.state, new))
    assert sum(same.messages) == 0


def test_graphs_are_kept_apart_and_negative_weights_refused(spark):
    rows = [("g", "a", "b", 1.0), ("g", "b", "a", 1.0), ("h", "a", "b", 2.0)]
    vertices = spark.createDataFrame(sorted({(r[0], x) for r in rows for x in r[1:3]}), "graph_id string, id string")
    pushed = push_pagerank(Graph(vertices, spark.createDataFrame(rows, "graph_id string, src string, dst string, weight double")), 0.5)
    found = {(r.graph_id, r.id): round(r.rank, 3) for r in pushed.state.collect()}
    assert found == {("g", "a"): 1.0, ("g", "b"): 1.0, ("h", "a"): 0.5, ("h", "b"): 0.75}
    with pytest.raises(ValueError):
        push_pagerank(graph_of(spark, [("a", "b", -1.0)], {"a", "b"}))


def test_empty_graph(spark):
    assert push_pagerank(graph_of(spark, [], set())).state.count() == 0
