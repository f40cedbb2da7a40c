from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citeloom.functions import display
from citeloom.functions.text import join_terms, parse_terms, publication_query, query_words, venue_matches, words


@pytest.fixture
def one(spark):
    def value(column):
        return spark.range(1).select(column.alias("x")).first().x

    return value


def test_terms_are_trimmed_and_empty_ones_dropped(one):
    assert one(parse_terms(F.lit(" x, ,y\t"))) == ["x", "y"]
    assert one(parse_terms(F.lit(""))) == []
    assert one(join_terms(parse_terms(F.lit("graph neural , nets")))) == "graph neural nets"
    assert one(publication_query(F.lit("Nature"), F.lit(2020))) == "Nature 2020"


def test_words_and_query_words_fold_alike(one):
    text = "Été-graph, GRAPH 2nd été"
    assert sorted(one(words(F.lit(text)))) == query_words(text) == ["graph", "nd", "été"]
    assert query_words(["a b", "b,c"]) == ["a", "b", "c"]


@pytest.mark.parametrize("venue,wanted,hit", [
    ("Nature Physics", "nature", True), (None, "", True), (None, "x", False), ("src10", "SRC1", True), ("abc", "B ", False)])
def test_venue_substring(one, venue, wanted, hit):
    assert one(venue_matches(F.lit(venue).cast("string"), F.lit(wanted))) is hit


def test_display_columns(one):
    assert one(display.thickness(F.lit(0.5))) == 2.5
    assert one(display.thickness(F.lit(None).cast("double"))) == 1.0
    assert one(display.thickness(F.lit(-1.0))) == 1.0
    assert one(display.weight_label(F.lit(0.12345))) == "0.123"
    assert one(display.weight_label(F.lit(-0.0001))) == "-0.000"
    assert one(display.tooltip(F.lit("t"), F.lit("v"), F.lit(2020))) == "t\nv (2020)"
    assert one(display.tooltip(F.lit(None).cast("string"))) == ""
    assert one(display.tooltip(F.lit("t"), F.lit(None).cast("string"), F.lit(None).cast("int"))) == "t\n ()"
