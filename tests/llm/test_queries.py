"""Registered queries against their SQL, and the pipeline end to end."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citeloom.llm import curriculum
from citeloom.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    with connect(SF_DIR) as con:
        assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(con, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    if name == "op10_compact_windows":
        assert found.where("first_doc_id >= doc_id").count() == 0
        assert found.join(documents, "doc_id", "left_anti").count() == 0
    else:
        assert found.count() == documents.count()


def test_taken_words_come_from_the_training_sequence(spark, monkeypatch):
    whole = {r.doc_id: r.taken for r in QUERIES["op6_mix_sources"](spark, SF_DIR).collect()}
    sequence = curriculum.training_sequence
    monkeypatch.setattr(curriculum, "training_sequence", lambda *a, **k: sequence(*a, **k).where("doc_id % 2 = 0"))
    half = {r.doc_id: r.taken for r in QUERIES["op6_mix_sources"](spark, SF_DIR).collect()}
    assert any(whole[d] for d in whole if d % 2)
    assert half == {d: 0 if d % 2 else n for d, n in whole.items()}


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    places = [r.position for r in rows]
    assert places == sorted(places) and len(rows) > 50
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        assert kept.select("doc_id").join(docs, "doc_id", "left_anti").count() == 0
        assert corpus_pipeline.STAGES[1][1] is not stage or kept.count() == kept.select(F.md5("text")).distinct().count()
