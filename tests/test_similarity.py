from __future__ import annotations

import random

import numpy as np
import pytest

from citeloom.operators.edges import citation_edges
from citeloom.operators.similarity import similarity_edges, similarity_pairs, tile_pairs
from citeloom.operators.tiles import deal, routed, routing_report
from citeloom.storage import Rounds

MICRO = {"10": [1.0, 0.0], "2": [1.0, 1.0], "b": [-1.0, 0.0]}


def rounded(df):
    return sorted((r.src, r.dst, round(r.weight, 6)) for r in df.collect())


def test_micro(vertices):
    v = vertices(MICRO)
    assert rounded(similarity_edges(v, 0.0)) == [("10", "2", 0.707107), ("2", "10", 0.707107)]
    assert rounded(similarity_pairs(v, -1.0)) == [("10", "2", 0.707107), ("10", "b", -1.0), ("2", "b", -0.707107)]
    assert len(rounded(similarity_edges(v, -1.0))) == 6


def test_unusable_vectors_have_weight_zero(vertices):
    v = vertices({"a": None, "b": [], "c": [0.0], "d": [1.0], "e": [1.0, None], "f": [float("nan")]})
    assert len(rounded(similarity_pairs(v, 0.0))) == 15
    assert all(w == 0.0 for _, _, w in rounded(similarity_pairs(v, 0.0)))
    assert rounded(similarity_pairs(v, 0.1)) == []


def test_large_graph_without_any_vector(vertices):
    assert similarity_pairs(vertices({str(i): None for i in range(20)}), 0.5, tile_bytes=500).count() == 0


def test_unequal_lengths_use_the_common_prefix(vertices):
    assert rounded(similarity_pairs(vertices({"a": [1.0, 2.0, 3.0], "b": [1.0, 2.0]}), 0.0)) == [("a", "b", 0.597614)]


def test_nan_weight_passes(vertices):
    rows = similarity_pairs(vertices({"a": [1e200], "b": [1e200]}), 0.5).collect()
    assert len(rows) == 1 and rows[0].weight != rows[0].weight


@pytest.mark.parametrize("threshold", [-0.5, 0.0, 0.3, 0.8])
@pytest.mark.parametrize("tile_bytes", [900, 10**6])
def test_tiles_find_exactly_the_pairs_of_brute_force(vertices, threshold, tile_bytes):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    x = centres[rng.integers(0, 5, 90)] + 0.4 * rng.normal(size=(90, 8))
    ids = [str(i) for i in range(90)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = unit @ unit.T
    want = sorted((a, b) for a in ids for b in ids if a < b and cos[int(a), int(b)] >= threshold)
    got = similarity_pairs(vertices(dict(zip(ids, x.tolist()))), threshold, tile_bytes=tile_bytes).collect()
    assert sorted((r.src, r.dst) for r in got) == want
    assert all(abs(r.weight - cos[int(r.src), int(r.dst)]) < 1e-12 for r in got)


def test_threshold_decisions_agree_with_the_native_expression(vertices, citations):
    rng = random.Random(9)
    vectors = {str(i): [float(rng.randint(-2, 2)) for _ in range(3)] for i in range(30)}
    pairs = [(a, b) for a in vectors for b in vectors if a < b]
    v = vertices(vectors)
    for threshold in (0.5, 1.0):
        native = {(r.src, r.dst) for r in citation_edges(v, citations(pairs), threshold).collect()}
        tiled = {(r.src, r.dst) for r in similarity_pairs(v, threshold, tile_bytes=1000).collect()}
        assert native == tiled


def test_many_graphs_of_uneven_size(spark):
    rng = random.Random(2)
    rows = [("big" if i % 3 else f"g{i}", f"{i:03d}", [rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(120)]
    v = spark.createDataFrame(rows, "graph_id string, id string, vector array<double>")
    whole = sorted((r.graph_id, r.src, r.dst) for r in similarity_pairs(v, 0.2).collect())
    tiled = sorted((r.graph_id, r.src, r.dst) for r in similarity_pairs(v, 0.2, tile_bytes=900).collect())
    assert whole == tiled and {g for g, _, _ in whole} == {"big"}


def test_papers_are_copied_once_per_tile(vertices):
    v = vertices({f"{i:03d}": [float(i), 1.0] for i in range(300)})
    for tile_bytes, tiles in ((10**6, 1), (6_000, 4)):
        dealt = tile_pairs(v, 0.9, tile_bytes)
        copies = dealt.count() / 300
        print("copies per paper", copies)
        assert copies == tiles
        assert dealt.select("tile_a", "tile_b").distinct().count() == tiles * (tiles + 1) // 2


def test_vectors_without_direction_are_compared(vertices):
    vectors = {f"{i:02d}": [float(i % 3 == k) for k in range(3)] for i in range(30)} | {"x": [1e200, 0.0, 0.0], "y": [1e200]}
    rows = similarity_pairs(vertices(vectors), 0.5, tile_bytes=500).collect()
    small = similarity_pairs(vertices(vectors), 0.5).collect()
    key = lambda r: (r.src, r.dst, repr(r.weight))
    assert sorted(map(key, rows)) == sorted(map(key, small))
    assert ("x", "y", "nan") in map(key, rows)


def clustered(rng, groups, each, dims=12):
    centres = rng.normal(size=(groups, dims))
    return {f"{g:02d}-{i:03d}": (centres[g] + 0.05 * rng.normal(size=dims)).tolist() for g in range(groups) for i in range(each)}


@pytest.mark.parametrize("threshold", [-1.0, 0.0, 0.4, 0.9, 1.0])
def test_pruned_tiles_give_the_pairs_of_all_tiles(vertices, threshold):
    rng = np.random.default_rng(7)
    odd = {"x": [1e200, 0.0], "y": [1e200], "z": [1e-160, 1e-160], "n": None, "e": [], "w": [float("inf"), 1.0], "o": [0.0, 0.0]}
    v = vertices(clustered(rng, 6, 15) | {f"r{i}": rng.normal(size=12).tolist() for i in range(20)} | odd)
    key = lambda r: (r.src, r.dst, repr(round(r.weight, 9)))
    whole = sorted(map(key, similarity_pairs(v, threshold, 900, prune=False).collect()))
    assert sorted(map(key, similarity_pairs(v, threshold, 900).collect())) == whole


def test_far_tiles_never_meet(spark, vertices):
    rng = np.random.default_rng(8)
    v = vertices(clustered(rng, 20, 60))
    with Rounds() as held:
        tiles = deal(v, 0.9, 6_000, held)
        report = routing_report(tiles).first()
        dealt = routed(tiles)
        print(report)
        assert report.papers == 1200 and report.copies_kept == dealt.count()
        assert report.tile_pairs_kept >= dealt.select("tile_a", "tile_b").distinct().count()
        assert report.copies_kept < report.copies / 2 and report.tile_pairs_kept < report.tile_pairs / 2


def test_one_direction_for_all_papers_is_split(vertices):
    v = vertices({f"{i:03d}": [1.0, 2.0, float(i % 2) / 1e6] for i in range(200)})
    with Rounds() as held:
        tiles = deal(v, 0.5, 2_000, held)
        sizes = [r["count"] for r in routed(tiles).select("id", "tile").distinct().groupBy("tile").count().collect()]
        assert sum(sizes) == 200 and max(sizes) < 60
    assert similarity_pairs(v, 0.5, 2_000).count() == 200 * 199 // 2


def test_pruning_keeps_graphs_apart(spark):
    rng = np.random.default_rng(9)
    rows = [(f"g{g}", i, x) for g in range(4) for i, x in clustered(rng, g + 1, 12).items()] + [(None, "a", [1.0]), (None, "b", [1.0])]
    v = spark.createDataFrame(rows, "graph_id string, id string, vector array<double>")
    key = lambda r: (r.graph_id or "", r.src, r.dst)
    named = v.where("graph_id IS NOT NULL")
    assert sorted(map(key, similarity_pairs(named, 0.8, 900).collect())) == sorted(map(key, similarity_pairs(named, 0.8, prune=False).collect()))
    assert similarity_pairs(v.where("id = 'none'"), 0.5).count() == 0
