from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from citeloom import PAPER_SCHEMA, Graph
from citeloom.operators.dedup import dedup_papers
from citeloom.sources import graph_files as files
from citeloom.sources import records, search
from citeloom.sources.sample_corpus import sample_records
from citeloom.storage import cut_lineage

JSON_LINES = [
    'null',
    'not json',
    '{"paperId":"b","year":"2020"}',
    '{"year":1}',
    '{"paperId":5,"extra":1}',
    '{"paperId":"n","references":null}',
    '{"paperId":"e","references":[]}',
    '{"paperId":"x","references":[{"paperId":null},{"paperId":"b"},{"paperId":"b"}],"embedding":{"vector":[1,2.5]}}',
    '{"paperId":"y","year":2020.5,"title":7}',
]


@pytest.fixture
def papers(spark):
    rows = [
        ("p1", "Graph rank", "about graphs and rank", "Nature", 2020),
        ("p2", "Graphs", "a graph", "nature physics", 2020),
        ("p3", None, "rank; RANK", None, 2020),
        ("p4", "paragraph", "nothing here", "Nature", 2019),
        ("p5", "Graph", None, "Science", None),
    ]
    return spark.createDataFrame(rows, "paperId string, title string, abstract string, venue string, year int")


def by_id(df):
    return {r.paperId: r for r in df.collect()}


@pytest.mark.parametrize("way", ["file", "column"])
def test_json_is_read_permissively(spark, tmp_path, way):
    if way == "file":
        (tmp_path / "papers.json").write_text("\n".join(JSON_LINES))
        df = records.read_json(spark, str(tmp_path))
    else:
        df = records.parse_json(spark.createDataFrame([(x,) for x in JSON_LINES], "value string"))
    assert df.columns == PAPER_SCHEMA.fieldNames()
    rows = df.collect()
    assert len(rows) == len(JSON_LINES)
    assert sum(all(v is None for v in r) for r in rows) == 2
    found = by_id(df.where("paperId IS NOT NULL"))
    assert found["b"].year is None
    assert found["5"].title is None
    assert found["n"].references is None and found["e"].references == []
    assert found["x"].embedding.vector == [1.0, 2.5]
    assert found["y"].year is None and found["y"].title == "7"
    pairs = records.explode_references(df.where("paperId IS NOT NULL")).collect()
    assert [tuple(r) for r in pairs] == [("x", "b")]


def test_corpus_from_records(spark):
    df = records.parse_json(spark.createDataFrame([(x,) for x in [
        '{"paperId":"a","references":[{"paperId":"b"},{"paperId":"b"}],"authors":[{"authorId":"1","name":"N"},{"name":"no id"}]}',
        '{"paperId":"a"}',
        '{"paperId":null,"references":[{"paperId":"b"}]}',
    ]], "value string"))
    corpus = records.corpus_from_records(df)
    assert [r.paperId for r in corpus.papers.collect()] == ["a"]
    assert [tuple(r) for r in corpus.citations.collect()] == [("a", "b")]
    assert [tuple(r) for r in corpus.authorships.collect()] == [("a", "1", "N")]


def test_dedup_prefers_complete_records(spark):
    lines = [
        '{"paperId":"a","title":"0 no vector"}',
        '{"paperId":"a","title":"1 no refs","embedding":{"vector":[1]}}',
        '{"paperId":"a","title":"3 full","embedding":{"vector":[1]},"references":[]}',
        '{"paperId":"a","title":"2 full","embedding":{"vector":[1]},"references":[]}',
        '{"paperId":null,"title":"x"}',
    ]
    df = records.parse_json(spark.createDataFrame([(x,) for x in lines * 3], "value string"))
    rows = dedup_papers(df).collect()
    assert [(r.paperId, r.title) for r in rows] == [("a", "2 full")]
    assert dedup_papers(df).columns == df.columns


def test_dedup_combines_before_the_shuffle(spark):
    df = records.parse_json(spark.createDataFrame([('{"paperId":"a"}',)], "value string"))
    plan = dedup_papers(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(__order" in plan


def test_keyword_search_matches_whole_words(papers):
    rows = search.keyword_search(papers, ["graph", "rank"]).collect()
    assert [(r.paperId, r.score) for r in rows] == [("p1", 2), ("p2", 1), ("p3", 1), ("p5", 1)]
    assert search.keyword_search(papers, "graph, rank", limit=1, offset=1).first().paperId == "p2"
    assert search.keyword_search(papers, " , ").count() == 0
    assert search.keyword_search(papers, "absent").count() == 0


def test_only_pages_are_clamped(spark):
    many = spark.range(300).select(F.format_string("%03d", "id").alias("paperId"), F.lit("word").alias("title"),
                                   F.lit("").alias("abstract"), F.lit(1).alias("year"))
    assert search.keyword_search(many, "word").count() == 300
    assert search.keyword_search(many, "word", limit=250).count() == 250
    assert search.keyword_search(many, "word", offset=250).count() == 50
    assert search.keyword_search(many, "word", limit=100, offset=250).count() == 50
    assert search.search_page(many, "word", limit=250).count() == 100
    preview = search.search_preview(many, "word").orderBy("position").collect()
    assert [(r.position, r.id, r.n_more) for r in preview] == [(i + 1, f"{i:03d}", 295) for i in range(5)]
    assert search.search_preview(many, "absent").count() == 0


def test_many_keyword_queries_agree_with_single_ones(spark, papers):
    asked = {"q1": ["graph"], "q2": ["rank", "here"], "q3": ["zzz"]}
    queries = spark.createDataFrame(list(asked.items()), "graph_id string, terms array<string>")
    got = {(r.graph_id, r.paperId, r.score) for r in search.keyword_hits_many(papers, queries).collect()}
    want = {(q, r.paperId, r.score) for q, terms in asked.items() for r in search.keyword_search(papers, terms).collect()}
    assert got == want


def test_lookup_and_missing_ids(spark, papers):
    wanted = ["p1", "p1", "zz"]
    frame = spark.createDataFrame([(i,) for i in [*wanted, None]], "paperId string")
    for ids in (wanted, frame):
        assert [r.paperId for r in search.lookup_ids(papers, ids).collect()] == ["p1"]
        assert [r.paperId for r in search.missing_ids(papers, ids).collect()] == ["zz"]
        with pytest.raises(LookupError):
            search.lookup_ids_strict(papers, ids)
    assert search.lookup_ids_strict(papers, ["p2"]).count() == 1
    assert [r.paperId for r in search.lookup_ids(papers, ["p1", *map(str, range(2000))]).collect()] == ["p1"]


def test_publication_search(spark, papers):
    found = lambda *a, **k: [r.paperId for r in search.publication_search(papers, *a, **k).collect()]
    assert found("NATURE", 2020) == ["p1", "p2"]
    assert found("", 2020) == ["p1", "p2", "p3"]
    assert found("nature", 2020, limit=1, offset=1) == ["p2"]
    queries = spark.createDataFrame([("a", "NATURE", 2020), ("b", "", 2020), ("c", "x", 1)],
                                    "graph_id string, publication string, year int")
    many = {(r.graph_id, r.paperId) for r in search.publication_hits_many(papers, queries).collect()}
    assert many == {("a", "p1"), ("a", "p2"), ("b", "p1"), ("b", "p2"), ("b", "p3")}


def test_embeddings_from_a_second_table(spark, papers):
    vectors = spark.createDataFrame([("p1", [1.0, 2.0])], "paperId string, vector array<float>")
    found = by_id(records.attach_embeddings(papers, vectors))
    assert found["p1"].embedding.vector == [1.0, 2.0] and found["p2"].embedding is None


def test_graph_round_trip(spark, tmp_path):
    vertices = spark.createDataFrame([("a", "A", None), ("b", "B", 2020), ("c", "C", 2021)], "id string, title string, year int")
    edges = spark.createDataFrame([("a", "b", 0.5, "citation"), ("b", "c", None, "x")],
                                  "src string, dst string, weight double, edge_type string")
    root = str(tmp_path)
    v_path, e_path = files.write_graph(Graph(vertices, edges), root)
    assert {d for d in os.listdir(v_path) if d.startswith("year=")} == {
        "year=2020", "year=2021", "year=__HIVE_DEFAULT_PARTITION__"}
    back = files.read_graph(spark, root)
    assert sorted(map(tuple, back.vertices.collect())) == [("a", "A", None), ("b", "B", 2020), ("c", "C", 2021)]
    assert sorted(map(tuple, back.edges.collect())) == sorted(map(tuple, edges.collect()))
    files.write_edges(edges, root, files=2, by_source=True)
    assert files.read_edges(spark, root).count() == 2
    pruned = files.read_vertices(spark, root, years=[2020])
    assert [r.id for r in pruned.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()


def test_dedup_shuffles_only_what_is_kept(spark):
    """The other columns still decide which record stays."""
    rows = [("a", "t", "x", [1.0]), ("a", "t", "y", [1.0]), ("b", None, "z", None), ("b", None, None, None), ("a", "u", "x", [1.0])]
    df = spark.createDataFrame(rows, "paperId string, title string, abstract string, embedding array<double>")
    whole, kept = dedup_papers(df), dedup_papers(df, keep=["title"])
    assert kept.columns == ["paperId", "title"]
    assert sorted(kept.collect(), key=str) == sorted(whole.select("paperId", "title").collect(), key=str)
    assert dedup_papers(df.select("paperId", "title")).count() == 2


def test_shuffle_files_go_with_the_write(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = held()
    cut = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before and cut.count() == 7


def test_records_of_tables_with_repeats_and_nulls(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    day = dt.datetime(1997, 3, 1)
    put("orders", [(1, day), (2, day), (None, day), (2, day)], "o_orderkey long, o_orderdate timestamp_ntz")
    put("lineitem", [(1, 30, 5), (1, 4, 5), (1, 30, None), (None, 4, 5), (2, None, 6)], "l_orderkey long, l_partkey long, l_suppkey long")
    put("supplier", [(5, "S5"), (5, "S5"), (None, "none")], "s_suppkey long, s_name string")
    put("documents", [(1, "first\nlast", "en", "web", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    put("embeddings", [(2, [1.0], 0)], "vec_id long, embedding array<float>, label int")
    found = [(r.paperId, r.title, r.references and [x.paperId for x in r.references], r.authors and [tuple(x) for x in r.authors])
             for r in sample_records(spark, str(tmp_path)).collect()]
    two = ("2", None, None, [("6", None)])
    assert sorted(found, key=str) == sorted(
        [("1", "first", ["30", "4"], [(None, None), ("5", "S5"), ("5", "S5")]), two, two, (None, None, None, None)], key=str)
