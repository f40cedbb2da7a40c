"""The inverted index gives the rows of the keyword search, from its own tables only."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from citeloom.plans import workflows as flows
from citeloom.schema import Corpus
from citeloom.sources import keyword_index, search
from citeloom.sources.keyword_index import KeywordIndex

WORDS = ["graph", "neural", "ranking", "Über", "the", "the", "of", "x", "größe", "graphs", "日本"]
SCHEMA = "paperId string, title string, abstract string"


def random_papers(seed, n, first=0):
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice(WORDS) + rng.choice(["", ",", "-", "1"]) for _ in range(rng.randint(0, k)))
    return [(f"p{i:04d}", text(4) if rng.random() < 0.9 else None, text(9) if rng.random() < 0.8 else None) for i in range(first, first + n)]


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def ordered(df):
    return [(r.paperId, r.score) for r in df.collect()]


@pytest.fixture(scope="module")
def papers(spark):
    return spark.createDataFrame([*random_papers(1, 400), (None, "graph", "the")], SCHEMA)


@pytest.fixture(scope="module")
def index(spark, papers, tmp_path_factory):
    return KeywordIndex(spark, str(tmp_path_factory.mktemp("index"))).build(papers, buckets=16)


@pytest.mark.parametrize("asked", ["graph", "graph, ranking", "the", "ÜBER größe x", "", "12 ,", "absent", ["the", "of", "neural", "日本"]])
def test_search(papers, index, asked):
    known = papers.where("paperId IS NOT NULL")
    assert rows(index.search(asked), "paperId", "score") == rows(search.keyword_search(known, asked), "paperId", "score")
    for limit, offset in ((1, 0), (5, 0), (10, 7), (400, 0), (3, 500), (0, 0)):
        assert ordered(index.search(asked, limit, offset)) == ordered(search.keyword_search(known, asked, limit, offset))


def test_a_frequent_word_reads_its_first_buckets_only(index):
    index.search("the", 5)
    assert index.buckets_read == 4 and index.buckets_held == 16


@pytest.mark.parametrize("limit", [None, 1, 7, 1000])
def test_search_many(spark, papers, index, limit):
    asked = spark.createDataFrame([("a", ["graph"]), ("b", ["the", "of"]), ("c", ["absent"]), ("d", []), ("e", ["x y", "Über"])],
                                  "graph_id string, terms array<string>")
    known = papers.where("paperId IS NOT NULL")
    columns = ("graph_id", "paperId", "score")
    assert rows(index.search_many(asked, limit), *columns) == rows(search.keyword_hits_many(known, asked, limit), *columns)


def test_plan_reads_words_asked_for_and_no_text(index):
    plan = index.search(["graph", "the"])._jdf.queryExecution().toString()
    assert "In(word, [graph,the])" in plan
    assert "title" not in plan and "abstract" not in plan


def test_updates_supersede_and_merge(spark, tmp_path):
    first, second = random_papers(2, 150), random_papers(3, 60, first=100)
    third = [("p0001", "graph graph", None), ("a", "ranking", "the"), ("zz", "ranking", "the"), ("p0120", None, None)]
    index = KeywordIndex(spark, str(tmp_path / "index")).build(spark.createDataFrame(first, SCHEMA), buckets=8)
    state = {r[0]: r for r in first}
    for batch, sent in enumerate((second, third), 1):
        index.update(spark.createDataFrame(sent, SCHEMA), batch)
        state |= {r[0]: r for r in sent}
        index.update(spark.createDataFrame(sent, SCHEMA), batch)  # a retry replaces the segment
        now = spark.createDataFrame(list(state.values()), SCHEMA)
        merged = index.merge(str(tmp_path / f"merged{batch}"))
        for asked in ("graph", "the, ranking, of"):
            expected = rows(search.keyword_search(now, asked), "paperId", "score")
            assert rows(index.search(asked), "paperId", "score") == expected
            assert ordered(index.search(asked, 12, 3)) == ordered(search.keyword_search(now, asked, 12, 3))
            assert rows(merged.search(asked), "paperId", "score") == expected
        assert merged._table("postings", "word string, paperId string, bucket int, fields int").select("segment").distinct().count() == 1
    index.build(spark.createDataFrame(third, SCHEMA))
    assert rows(index.search("graph"), "paperId", "score") == [("p0001", 1)]


def test_fields_tell_title_from_abstract(spark, tmp_path):
    index = KeywordIndex(spark, str(tmp_path / "i")).build(spark.createDataFrame([("a", "x y", "y z")], SCHEMA))
    postings = spark.read.parquet(f"{index.path}/postings").where(F.col("paperId") == "a")
    assert rows(postings, "word", "fields") == [("x", 1), ("y", 3), ("z", 2)]


def test_empty_corpus(spark, tmp_path):
    index = KeywordIndex(spark, str(tmp_path / "i")).build(spark.createDataFrame([], SCHEMA))
    assert index.search("graph").count() == 0 and index.search("graph", 5).count() == 0
    with pytest.raises(ValueError):
        index.update(spark.createDataFrame([], SCHEMA), 0)


def test_workflows_by_index(spark, tmp_path):
    papers = spark.createDataFrame(random_papers(8, 40), SCHEMA)
    none = "year int, venue string, embedding struct<model:string,vector:array<double>>, tldr struct<text:string>"
    for field in none.split(", "):
        name, kind = field.split(" ", 1)
        papers = papers.withColumn(name, F.lit(None).cast(kind))
    cited = spark.createDataFrame([(f"p{i:04d}", f"p{(i * 7) % 40:04d}") for i in range(40)], "src string, dst string")
    corpus, index = Corpus(papers, cited), KeywordIndex(spark, str(tmp_path / "i")).build(papers)
    key = lambda r: tuple(map(str, r))
    asked = spark.createDataFrame([("g", "graph, the", "p0003"), ("h", "of", None)], "graph_id string, keywords string, central string")
    for limit in (None, 6):
        for plain, quick in (
                (flows.keyword_graph(corpus, "graph, the", limit, "p0003"), flows.keyword_graph(corpus, "graph, the", limit, "p0003", index=index)),
                (flows.keyword_graphs(corpus, asked, limit), flows.keyword_graphs(corpus, asked, limit, index))):
            assert sorted(map(key, quick.edges.collect())) == sorted(map(key, plain.edges.collect()))
            columns = plain.vertices.columns
            assert sorted(map(key, quick.vertices.select(columns).collect())) == sorted(map(key, plain.vertices.collect()))


def test_postings_are_shuffled_once(spark):
    """Repeated rows become one by the shuffle that makes the ranges, and a bucket is found by halving."""
    rows_ = spark.createDataFrame([("a", "p1", 0, 1), ("a", "p1", 0, 2), ("b", "p1", 0, 2)], "word string, paperId string, bucket int, fields int")
    dealt = keyword_index._dealt(rows_)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(map(tuple, dealt.collect())) == [("a", "p1", 0, 3), ("b", "p1", 0, 2)]
    bounds = ["b", "d", "d1", "f", "x"]
    ids = spark.createDataFrame([(x,) for x in "abcdefxyz"] + [("d1",), ("d2",), ("",)], "id string")
    found = ids.select("id", keyword_index._bucket(F.col("id"), bounds).alias("n")).collect()
    assert {r.id: r.n for r in found} == {r.id: sum(b <= r.id for b in bounds) for r in found}


def test_superseded_ids_come_from_the_list_of_papers(spark, tmp_path):
    """An update reads no postings, and each word of a paper is stored once, in order."""
    index = KeywordIndex(spark, str(tmp_path / "index")).build(spark.createDataFrame(random_papers(5, 40), SCHEMA), buckets=4)
    read = []
    table = index._table
    index._table = lambda name, schema: read.append(name) or table(name, schema)
    again = spark.createDataFrame([("p0003", "graph graph", "graph"), ("p0003", None, "new"), ("p0900", "new", None)], SCHEMA)
    index.update(again, 1)
    assert "postings" not in read
    del index._table
    assert sorted(ordered(index.search("new"))) == [("p0003", 1), ("p0900", 1)]
    assert [r.word for r in index._live().where("paperId = 'p0003'").orderBy("word").collect()] == ["graph", "new"]
    for part in (tmp_path / "index" / "postings" / "segment=1").glob("*.parquet"):
        stored = [(r.word, r.paperId) for r in spark.read.parquet(str(part)).collect()]
        assert stored == sorted(stored) and len(set(stored)) == len(stored)
