"""Steps whose cost must not hang on one hot vertex, on vertices that never change, or on a second look at the records."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import PACKED
from citeloom.operators import community, moving, push, rank
from citeloom.operators.dedup import dedup_papers
from citeloom.operators.edges import star_edges
from citeloom.schema import Graph
from citeloom.sources.sample_corpus import COLUMNS, sample_papers
from citeloom.storage import Rounds, n_files, shared_dir
from citeloom.streaming import updates


def _graph(spark, pairs, ids=None):
    ids = ids or sorted({i for p in pairs for i in p})
    edges = spark.createDataFrame([(a, b, 0.5) for a, b in pairs], "src string, dst string, weight double")
    return Graph(spark.createDataFrame([(i, f"title {i}") for i in ids], "id string, title string"), edges)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_components_split_a_hot_root(spark):
    leaves = [(f"b{i:03}", "a") for i in range(60)]
    g = _graph(spark, [*leaves, ("b000", "c"), ("x", "y")], ["a", "c", "x", "y", "z", *[b for b, _ in leaves]])
    found = dict(map(tuple, community.connected_components(g, hot_floor=10).collect()))
    assert found == {**{i: "a" for i in found if i not in "xyz"}, "x": "x", "y": "x", "z": "z"}
    with Rounds() as rounds:
        edges = rounds.cut(g.edges.select("src", "dst"))
        salts = community._least_at(edges, "dst", [], rounds, 10).where("dst = 'a'").select("salt").distinct()
        assert salts.count() == 6


def test_star_joins_the_centre_without_a_shuffle(spark):
    """All links of a star share the centre, which no shuffle may gather in one task."""
    v = spark.createDataFrame([(i, [1.0, float(n)]) for n, i in enumerate("abcd")], "id string, vector array<double>")
    c = spark.createDataFrame([("a", "b"), ("c", "a"), ("b", "c"), ("a", "a")], "src string, dst string")
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    try:
        edges = star_edges(v, c, "a")
        assert "BroadcastHashJoin [centre" in _plan(edges)
        kinds = sorted(map(tuple, edges.select("src", "dst", "edge_type").collect()))
    finally:
        for n, value in old.items():
            spark.conf.set(n, value)
    assert kinds == [("a", "a", "central_cites"), ("a", "a", "cites_central"), ("a", "b", "central_cites"),
                     ("a", "d", "fallback"), ("b", "c", "seed_cite"), ("c", "a", "cites_central")]


def _plain_ranks(pairs, ids, rounds):
    ranks = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        ranks = {i: 0.15 + 0.85 * sum(ranks[a] * 0.5 for a, b in pairs if b == i and a in ranks) for i in ids}
    return ranks


@pytest.mark.parametrize("max_iter", [1, 2, 7])
def test_rank_rounds_run_on_vertices_that_send_and_receive(spark, monkeypatch, max_iter):
    kept = []

    class Seen(rank.PlacedEdges):
        def __init__(self, *args):
            super().__init__(*args)
            kept.append(self.written.count())

    monkeypatch.setattr(rank, "PlacedEdges", Seen)
    pairs = [("s1", "a"), ("s2", "a"), ("s2", "t1"), ("a", "b"), ("b", "a"), ("b", "t2"), ("gone", "a"), ("a", "gone")]
    ids = ["s1", "s2", "a", "b", "t1", "t2", "alone"]
    found = {r["id"]: r["rank"] for r in rank.pagerank(_graph(spark, pairs, ids), max_iter=max_iter, hot_floor=1).collect()}
    assert found == pytest.approx(_plain_ranks(pairs, ids, max_iter))
    assert kept == [2]


def test_ranks_of_repeated_vertices_count_each(spark):
    g = _graph(spark, [("a", "b"), ("b", "a"), ("s", "a")], ["a", "a", "b", "s", "s"])
    found = sorted((r["id"], round(r["rank"], 9)) for r in rank.pagerank(g, max_iter=2).collect())
    a, b = 0.15 + 0.85 * (0.5 + 1.0), 0.15 + 0.85 * 1.0
    a, b = 0.15 + 0.85 * (b * 0.5 + 0.15), 0.15 + 0.85 * a
    assert found == [("a", round(a, 9))] * 4 + [("b", round(b, 9))] + [("s", 0.15)] * 4


def test_push_sends_along_edges_that_stay(spark, monkeypatch):
    class Seen(push.PlacedEdges):
        def send(self, values):
            sent = super().send(values)
            assert "InMemoryTableScan" in _plan(sent)
            return sent

    monkeypatch.setattr(push, "PlacedEdges", Seen)
    found = {r["id"]: r["rank"] for r in push.push_pagerank(_graph(spark, [("a", "b"), ("b", "a"), ("a", "c")]), tolerance=1e-9).state.collect()}
    a, b, c = found["a"], found["b"], found["c"]
    assert (a, b, c) == pytest.approx((0.15 + 0.85 * b, 0.15 + 0.425 * a, 0.15 + 0.425 * a), abs=1e-7)


def test_dedup_reads_and_shuffles_records_once(spark):
    rows = [("p", "t2", 1), ("p", "t1", 2), (None, "t", 3), ("q", None, 4), ("q", None, 4)]
    kept = dedup_papers(spark.createDataFrame(rows, "paperId string, title string, n int").withColumn("embedding", F.lit(None).cast("string")))
    assert _plan(kept).count("Exchange hashpartitioning") == 1 and "Join" not in _plan(kept)
    assert sorted(map(tuple, kept.select("paperId", "n").collect())) == [("p", 2), ("q", 4)]


def test_votes_are_shuffled_once(spark):
    rows = [("a", "x", "0.5"), ("a", "y", "0.2"), ("a", "y", "0.3"), ("a", "z", "-1"), ("b", "z", "-1"), ("b", "y", None)]
    votes = spark.createDataFrame(rows, "id string, label string, vote string").withColumn("vote", F.col("vote").cast("decimal(28,9)"))
    once = community._elected(votes, None, [])
    assert _plan(once).count("Exchange hashpartitioning") == 1
    hot = spark.createDataFrame([("a", 3)], "src string, fan int")
    for found in (once, community._elected(votes, hot, [])):
        assert sorted(map(tuple, found.collect())) == [("a", "x"), ("b", "y")]


def test_half_rounds_follow_links_of_vertices_that_may_move(spark, monkeypatch):
    seen, plain = [], moving.best_moves

    def best_moves(links, placed, keys, half=None):
        seen.append((links.select("src").distinct().count(), placed.where(half).count(), placed.count()))
        found = plain(links, placed, keys, half)
        assert _plan(found).count("Exchange hashpartitioning(target") == 0
        return found

    monkeypatch.setattr(moving, "best_moves", best_moves)
    ids = [f"v{i:02}" for i in range(12)]
    pairs = [(a, b) for i, a in enumerate(ids) for j, b in enumerate(ids) if i < j and i // 4 == j // 4]
    moving.modularity_communities(_graph(spark, [*pairs, ("v00", "v11")], ids), max_levels=1, max_rounds=1)
    assert len(seen) == 2 and all(of_links == movers < every for of_links, movers, every in seen)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_batch_leaves_no_shuffle_files(spark, tmp_path):
    records = spark.createDataFrame(
        [(f"p{i}", "t", "text", [(f"p{i - 1}",)]) for i in range(9)] * 2,
        "paperId string, title string, abstract string, references array<struct<paperId string>>").withColumns({
            "year": F.lit(2000), "embedding": F.lit(None).cast("struct<model string, vector array<double>>"),
            "ingest_ts": F.current_timestamp()})
    nothing = spark.createDataFrame([], "id string, title string, year int, vector array<double>")
    before = _shuffle_files(spark)
    updates.store_batch(records, 0, str(tmp_path), nothing)
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert updates.read_appended_edges(spark, str(tmp_path)).count() == 8


def test_packed_records_are_streamed(spark, tmp_path):
    """What the streaming queries send is packed, and read like plain files."""
    rows = spark.createDataFrame([(f"p{i}", "t") for i in range(9)], "paperId string, title string").withColumns(
        {"references": F.array(F.struct(F.lit("p1").alias("paperId"))), "ingest_ts": F.current_timestamp()})
    rows.coalesce(1).write.options(maxRecordsPerFile=4, **PACKED).json(f"{tmp_path}/inbox")
    assert all(f.endswith(".json.gz") for f in os.listdir(f"{tmp_path}/inbox") if f.startswith("part-"))
    assert n_files(spark, f"{tmp_path}/inbox") == 3
    nothing = spark.createDataFrame([], "id string, title string, year int, vector array<double>")
    stream = updates.read_paper_stream(spark, f"{tmp_path}/inbox", max_files=1)
    updates.append_papers(stream, nothing, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    assert updates.read_appended_edges(spark, f"{tmp_path}/out").count() == 9


def test_rank_rounds_hold_two_copies_of_the_edges(spark, monkeypatch):
    """All edges, and those that the rounds run on; edges towards the core go before the rounds begin."""
    held, place = [], rank.place

    def spy(df, *args):
        folder = shared_dir(spark).removeprefix("file:")
        tables = [f"{folder}/{x}" for x in os.listdir(folder) if x.startswith("cut-")]
        held.append(sum({"src", "dst", "weight"} <= set(spark.read.parquet(t).columns) for t in tables if t not in before))
        return place(df, *args)

    folder = shared_dir(spark).removeprefix("file:")
    before = {f"{folder}/{x}" for x in os.listdir(folder)}
    monkeypatch.setattr(rank, "place", spy)
    pairs = [("a", "b"), ("b", "a"), ("c", "a"), ("a", "d")]
    found = {r.id: r["rank"] for r in rank.pagerank(_graph(spark, pairs), max_iter=7).collect()}
    assert held == [2]
    assert found == pytest.approx(_plain_ranks(pairs, "abcd", 7))


def test_titles_are_shuffled_without_their_texts(spark, tmp_path):
    for name, columns in COLUMNS.items():
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    text = spark.createDataFrame([(1, "first\nlast", "en", "web", 9), (2, None, "en", None, 9)], COLUMNS["documents"])
    text.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    orders = [(1, dt.datetime(1997, 1, 1)), (2, None), (3, None)]
    spark.createDataFrame(orders, COLUMNS["orders"]).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    whole, slim = (sample_papers(spark, str(tmp_path), texts) for texts in (True, False))
    read = ["paperId", "title", "venue", "year", "embedding"]
    assert sorted(slim.select(read).collect(), key=str) == sorted(whole.select(read).collect(), key=str)
    assert [r.title for r in slim.orderBy("paperId").collect()] == ["first", None, None]
    plan = _plan(slim.select("paperId", "title"))
    assert "split(text" in plan[plan.index("Exchange"):]
