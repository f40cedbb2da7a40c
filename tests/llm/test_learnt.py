"""Quality classifier and toxicity lexicon: gradients, folding, held-out accuracy, edge cases."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import labels as sampling
from citeloom.llm import quality_mil, toxicity

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality_mil.FEATURES)).astype(np.float32) for n in (1, 3, 5)]
    y = np.array([0.0, 1.0, 1.0])
    model = quality_mil.fit(bags, y, 0.0, epochs=1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x = (np.concatenate(bags).astype(np.float64) - model.mean) / model.scale
    first, bag = np.array([0, 1, 4]), np.repeat([0, 1, 2], [1, 3, 5])

    def loss():
        p = quality_mil._sigmoid(model._forward(x, first, bag)[-1])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality_mil._gradients(model, x, first, bag, y)
    for name, g in grads.items():
        flat = model.weights[name].reshape(-1)
        for k in rng.choice(len(flat), min(5, len(flat)), replace=False):
            old = flat[k]
            flat[k] = old + 1e-5
            up = loss()
            flat[k] = old - 1e-5
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-5 - g.reshape(-1)[k]) < 1e-5


def test_passages_cover_whole_texts():
    texts = ["", None, "one two", " ".join(["w"] * 129), "  lead", "\n"]
    x, owner = quality_mil.encode(pa.array(texts, pa.string()))
    assert owner.tolist() == [0, 1, 2, 3, 3, 3, 4, 5]
    alone = np.concatenate([quality_mil.encode(pa.array([t], pa.string()))[0] for t in texts])
    assert np.allclose(x, alone)


def test_fold():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot")
    assert toxicity.fold("іdіоt") == toxicity.fold("ＩＤＩＯＴ") == toxicity.fold("idíöt") == "idiot"
    assert toxicity.fold("cl0wn") == toxicity.fold("c|own") == toxicity.fold("clown")
    assert toxicity.fold("i\u200bdiot") == "idiot"


def test_matcher_boundaries_and_exceptions():
    lexicon = toxicity.Lexicon({"scum": 2.0}, {"moro": 1.0}, ("scum bag race",))
    hits = lexicon.matcher().hits
    assert hits("scum, scums oscum moronic amoron") == {"scum": (2.0, 1), "moro": (1.0, 1)}
    assert hits("a scum bag race") == {}
    assert hits("") == {} and toxicity.Lexicon().matcher().hits("scum") == {}


def accuracy(scored, labels, label, threshold):
    known = scored.join(labels, "doc_id").where(sampling.held_out(F.col("doc_id")))
    right = F.avg(((F.col("score") >= threshold).cast("int") == F.col(label)).cast("double"))
    return known.agg(right).first()[0]


@needs_tables
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    quality = quality_mil.score(docs, quality_mil.train(docs, labels))
    assert accuracy(quality, labels, "quality", 0.3) >= 0.95
    toxic = toxicity.score(docs, toxicity.learn(docs, labels))
    assert accuracy(toxic, labels, "toxic", 0.5) >= 0.93


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "good text here", "a", 0.5), (1, "good text here", "a", 0.5), (2, None, None, None), (None, "", "b", 1.0),
            (3, "x " * 30_000, "c", 2.0), (4, "   ", "d", 3.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, y string, score double")


@pytest.mark.parametrize("rows, value", [([], 0.5), ([(1, 1, 1)], 1.0), ([(1, 0, 0), (2, 0, 0)], 0.0)])
def test_few_labels(spark, odd, rows, value):
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = quality_mil.score(odd, quality_mil.train(odd, table))
    assert found.columns == ["doc_id", "text", "y", "score"]
    assert [r.score for r in found.collect()] == [value] * 6
    toxic = toxicity.score(odd, toxicity.learn(odd, table)).collect()
    assert [r.score for r in toxic] == [0.0 if not rows else value] * 6


def test_odd_rows_with_both_labels(spark, odd):
    table = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, 0, 1), (4, None, None), (None, 1, 1), (5, 7, 7)],
                                  "doc_id long, quality int, toxic int")
    quality = quality_mil.score(odd, quality_mil.train(odd, table)).collect()
    toxic = toxicity.score(odd, toxicity.learn(odd, table)).collect()
    assert len(quality) == len(toxic) == 6
    assert all(0 <= r.score <= 1 for r in [*quality, *toxic])
    assert quality_mil.keep_good(odd, table).columns == odd.columns
    assert quality_mil.score(odd.limit(0), quality_mil.train(odd, table)).count() == 0
    assert toxicity.score(odd.limit(0), toxicity.learn(odd.limit(0), table)).count() == 0


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    table = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample = sampling.training_sample(docs, table, "toxic", 30, 100)
    assert {r.y: r["count"] for r in sample.groupBy("y").count().collect()} == {0: 30, 1: 30}
    assert sample.where(sampling.held_out(F.col("doc_id"))).count() == 0
    assert sampling.training_sample(docs, table, "toxic", 30, 5).count() == 0
