"""The graph grown from keyed state equals the batch answer."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from citeloom.operators.edges import citation_edges
from citeloom.schema import PAPER_SCHEMA
from citeloom.sources.records import corpus_from_records
from citeloom.streaming import stateful, updates


def record(rng, i, n, vector=True):
    refs = [{"paperId": f"p{rng.randrange(n)}"} for _ in range(rng.randint(0, 5))] + [{"paperId": "p0"}]
    return {"paperId": f"p{i}", "title": f"t{i}", "year": 2000 + i % 9, "references": refs if i % 7 else None,
            "embedding": {"model": "m", "vector": [rng.random(), rng.random()]} if vector and i % 5 else None}


def key(r):
    return r.src, r.dst, round(r.weight, 9), r.edge_type


def frame(spark, rows):
    return spark.createDataFrame(rows, PAPER_SCHEMA)


def send(spark, rows, inbox):
    frame(spark, rows).withColumn("ingest_ts", F.current_timestamp()).coalesce(1).write.mode("append").json(inbox)


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_equals_batch_over_restarts(spark, tmp_path, salts):
    """Records come in three calls, out of order, some twice; a third of the papers is known before."""
    rng = random.Random(salts)
    records = [record(rng, i, 60) for i in range(50)]
    everything = corpus_from_records(frame(spark, records))
    vertices = everything.papers.select(F.col("paperId").alias("id"), "title", "year", F.col("embedding.vector").alias("vector"))
    first = F.substring("id", 2, 9).cast("int") % 3 == 0
    base = vertices.where(first)
    cited = everything.citations.where(F.substring("src", 2, 9).cast("int") % 3 == 0)
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    arriving = [r for i, r in enumerate(records) if i % 3] + records[:12]
    rng.shuffle(arriving)
    for part in (arriving[:9], arriving[9:30], arriving[30:] + arriving[:20]):
        send(spark, part, inbox)
        stream = updates.read_paper_stream(spark, inbox, max_files=1)
        stateful.grow_graph(stream, base, out, f"{tmp_path}/progress", cited, salts)
    got = citation_edges(base, cited).unionByName(stateful.read_edges(spark, out))
    batch = citation_edges(vertices, everything.citations)
    assert sorted(map(key, got.collect())) == sorted(map(key, batch.collect()))
    papers = [r.id for r in stateful.read_papers(spark, out).collect()]
    assert sorted(papers) == sorted(f"p{i}" for i in range(50) if i % 3)
    before = stateful.read_edges(spark, out).count()
    stateful.grow_graph(updates.read_paper_stream(spark, inbox), base, out, f"{tmp_path}/progress", cited, salts)
    assert stateful.read_edges(spark, out).count() == before


def test_best_record_of_a_batch_and_first_batch_stay(spark, tmp_path):
    rng = random.Random(5)
    good, bare = record(rng, 1, 9), record(rng, 1, 9, vector=False) | {"title": "a"}
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    nothing = spark.createDataFrame([], "id string, title string, year int, vector array<double>")
    for rows in ([bare, good, bare], [good | {"title": "later", "references": [{"paperId": "p99"}]}]):
        send(spark, rows, inbox)
        stateful.grow_graph(updates.read_paper_stream(spark, inbox), nothing, out, f"{tmp_path}/progress")
    (paper,) = stateful.read_papers(spark, out).collect()
    assert paper.title == "t1" and paper.vector is not None and "p99" not in paper.cited


def test_a_batch_does_not_read_the_graph(spark, tmp_path):
    """Neither the stored papers nor the edges are a source of the queries' plans after the first batch."""
    rng = random.Random(6)
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    base = spark.createDataFrame([("p0", "t", 2000, [1.0, 1.0])], "id string, title string, year int, vector array<double>")
    for i in (1, 2):
        send(spark, [record(rng, i, 9)], inbox)
        query = stateful.store_new_papers(updates.read_paper_stream(spark, inbox), base, out, f"{tmp_path}/progress")
        query.awaitTermination()
        edges = stateful.store_completed_edges(spark, base, out, f"{tmp_path}/progress")
        edges.awaitTermination()
    # The second call has read one file of one record, and one new paper.
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert sum(p["numInputRows"] for p in edges.recentProgress) == 1
    assert [o["numRowsTotal"] for o in query.recentProgress[-1]["stateOperators"]] == [3]


def test_edges_are_written_by_a_join_of_streams(spark, tmp_path):
    """Every new paper is read once, all edges are there on return, and a known paper held twice completes an edge once."""
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    base = spark.createDataFrame([("p0", "t", 2000, [1.0, 1.0])] * 2, "id string, title string, year int, vector array<double>")
    send(spark, [record(random.Random(i), i, 1) for i in (1, 2, 3)], inbox)
    stateful.store_new_papers(updates.read_paper_stream(spark, inbox), base, out, f"{tmp_path}/progress").awaitTermination()
    read = stateful.store_completed_edges(spark, base, out, f"{tmp_path}/progress")
    assert not read.isActive and sum(p["numInputRows"] for p in read.recentProgress) == 3
    assert sorted((r.src, r.dst) for r in stateful.read_edges(spark, out).collect()) == [("p1", "p0"), ("p2", "p0"), ("p3", "p0")]


def test_citations_of_a_paper_are_blocks_in_the_state(spark, tmp_path, monkeypatch):
    """The join keeps a row per block, not per citation; a hot paper has several, and all edges come once."""
    monkeypatch.setattr(stateful, "BLOCK", 8)
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    nothing = spark.createDataFrame([], "id string, title string, year int, vector array<double>")
    hot = {"title": "t", "year": 2000, "embedding": {"model": "m", "vector": [1.0]}}
    first = [hot | {"paperId": f"p{i}", "references": [{"paperId": "hub"}, {"paperId": "none"}]} for i in range(40)]
    for rows in (first, [hot | {"paperId": "hub", "references": [{"paperId": "hub"}]}]):
        send(spark, rows, inbox)
        stateful.grow_graph(updates.read_paper_stream(spark, inbox), nothing, out, f"{tmp_path}/progress")
    waiting = [r for r in spark.read.option("recursiveFileLookup", True).parquet(f"{out}/arrived").collect() if r.citing]
    assert 2 < len([r for r in waiting if r.id == "hub"]) < 20
    assert sorted((r.src, r.dst, round(r.weight, 9)) for r in stateful.read_edges(spark, out).collect()) == sorted(
        [("hub", "hub", 1.0), *[(f"p{i}", "hub", 1.0) for i in range(40)]])
