from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from citeloom import Graph
from citeloom.operators.rank import pagerank
from citeloom.operators.report import graph_stats, top_ranked, viz_edges, viz_nodes
from citeloom.storage import release, shared_dir


def ranks_of(df):
    return {r.id: r.rank for r in df.collect()}


@pytest.fixture
def graph(spark):
    def build(ids, edges):
        v = spark.createDataFrame([(i, f"t{i}") for i in ids], "id string, title string")
        return Graph(v, spark.createDataFrame(edges, "src string, dst string, weight double"))

    return build


@pytest.mark.parametrize("rounds,want", [
    (0, {"a": 1.0, "b": 1.0, "c": 1.0}),
    (1, {"a": 0.15, "b": 0.575, "c": 1.0}),
    (2, {"a": 0.15, "b": 0.21375, "c": 0.63875}),
])
def test_micro(graph, rounds, want):
    got = pagerank(graph("abc", [("a", "b", 0.5), ("b", "c", 1.0)]), max_iter=rounds)
    assert got.columns == ["id", "rank", "title"]
    assert ranks_of(got) == pytest.approx(want)


def dense(ids, edges, rounds=10, alpha=0.15):
    at = {v: i for i, v in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for s, d, x in edges:
        w[at[s], at[d]] += x
    rank = np.ones(len(ids))
    for _ in range(rounds):
        rank = alpha + (1 - alpha) * (rank @ w)
    return dict(zip(ids, rank))


@pytest.mark.parametrize("hot_floor,checkpoint_every", [(10**6, 3), (10**6, 100), (4, 3)])
def test_against_a_dense_iteration(graph, hot_floor, checkpoint_every):
    """Plain, in one plan, and with salted sources."""
    rng = random.Random(7)
    ids = [f"p{i}" for i in range(30)]
    edges = [("p0", i, rng.uniform(-0.2, 0.2)) for i in ids] + [(i, "p1", 0.1) for i in ids]
    edges += [(rng.choice(ids), rng.choice(ids), rng.uniform(-0.3, 0.3)) for _ in range(80)]
    got = ranks_of(pagerank(graph(ids, edges), hot_floor=hot_floor, checkpoint_every=checkpoint_every))
    assert got == pytest.approx(dense(ids, edges), abs=1e-9)


def test_normalized_weights(graph):
    edges = [("a", "b", 2.0), ("a", "c", 6.0), ("b", "c", 5.0)]
    scaled = [("a", "b", 0.25), ("a", "c", 0.75), ("b", "c", 1.0)]
    assert ranks_of(pagerank(graph("abc", edges), normalize=True)) == pytest.approx(dense("abc", scaled))


def test_many_graphs_at_once(spark, graph):
    edges = {"g": [("a", "b", 0.5)], "h": [("b", "a", 0.9), ("c", "a", 0.3)]}
    v = spark.createDataFrame([(g, i, "t") for g in edges for i in "abc"], "graph_id string, id string, title string")
    e = spark.createDataFrame([(g, *x) for g, es in edges.items() for x in es],
                              "graph_id string, src string, dst string, weight double")
    got = {(r.graph_id, r.id): r.rank for r in pagerank(Graph(v, e)).collect()}
    want = {(g, i): r for g, es in edges.items() for i, r in dense("abc", es).items()}
    assert got == pytest.approx(want)


def test_a_round_shuffles_only_the_sums(spark, graph, monkeypatch):
    """Placed vertices and edges are joined where they are."""
    from citeloom.operators import rank as module
    plans = []
    real = module.cut_lineage

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(module, "cut_lineage", spy)
    module.pagerank(graph("abc", [("a", "b", 0.5)]), max_iter=3)
    assert plans[-1].count("ENSURE_REQUIREMENTS") <= 5


def test_scratch_is_removed_with_the_result(spark, graph):
    def held():
        return sorted(p.name for p in Path(shared_dir(spark).removeprefix("file:")).iterdir())

    before = held()
    result = pagerank(graph("abc", [("a", "b", 0.5), ("b", "c", 1.0)]), checkpoint_every=2)
    assert result.count() == 3 and len(held()) == len(before) + 1
    assert "ReadSchema: struct<id:string>" in result.select("id")._jdf.queryExecution().executedPlan().toString()
    release(result)
    assert held() == before


def test_top_ranked_breaks_ties_by_id(spark):
    ranks = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "id string, rank double")
    assert [(r.position, r.id) for r in top_ranked(ranks, 2).orderBy("position").collect()] == [(1, "c"), (2, "a")]
    keyed = spark.createDataFrame([("g", "b", 1.0), ("g", "a", 1.0), ("h", "c", 2.0)], "graph_id string, id string, rank double")
    top = top_ranked(keyed, 1)
    assert sorted((r.graph_id, r.id) for r in top.collect()) == [("g", "a"), ("h", "c")]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_display_tables(spark):
    ranks = spark.createDataFrame(
        [(f"{i:02d}", float(i), f"t{i}", "V", 2000 + i) for i in range(12)] + [("zz", -1.0, None, None, None)],
        "id string, rank double, title string, venue string, year int")
    rows = {r.id: r for r in viz_nodes(ranks).collect()}
    assert len(rows) == 13
    assert rows["11"].label == "t11" and rows["11"].size == 20 and rows["11"].size_scaled == 20.0
    assert rows["01"].label == " " and rows["01"].size == 10
    assert rows["zz"].hover == "" and rows["zz"].size_scaled == 0.0
    assert viz_nodes(ranks, blank="", with_venue=True).where("id = '11'").first().hover == "t11\nV (2011)"

    edges = spark.createDataFrame([("a", "b", 0.5, "citation"), ("a", "c", None, "fallback")],
                                  "src string, dst string, weight double, edge_type string")
    shown = {r.dst: tuple(r)[2:] for r in viz_edges(edges).collect()}
    assert shown == {"b": (2.5, "0.500", None, None), "c": (1.0, "0.000", "black", "")}
    assert viz_edges(edges.drop("edge_type")).where("color IS NOT NULL").count() == 0


def test_graph_stats(spark, graph):
    assert tuple(graph_stats(graph("abcd", [("a", "b", 1.0)])).first()) == (4, 6, 1)
