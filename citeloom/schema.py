"""Column names and types of the paper record and of the graph tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_ID_LIST = T.ArrayType(T.StructType([T.StructField("paperId", T.StringType(), False)]))

# The record layout of the paper feed. One superset serves the
# keyword, paper-id and publication workflows.
PAPER_SCHEMA = T.StructType([
    T.StructField("paperId", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("authors", T.ArrayType(T.StructType([
        T.StructField("authorId", T.StringType()),
        T.StructField("name", T.StringType()),
    ]))),
    T.StructField("references", _ID_LIST),
    T.StructField("citations", _ID_LIST),
    T.StructField("embedding", T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("vector", T.ArrayType(T.DoubleType())),
    ])),
    T.StructField("tldr", T.StructType([T.StructField("text", T.StringType())])),
])

#: Optional column that lets one DataFrame hold many graphs.
GRAPH_ID = "graph_id"


class Corpus(NamedTuple):
    """A paper collection in normal form.

    ``papers`` has one row per ``paperId``; ``citations`` has one row per
    ``(src, dst)`` and no null; ``authorships`` has one row per
    ``(paperId, authorId)``. Long lists live as rows, so a paper with a huge
    reference list is split over tasks like any other data.
    """

    papers: DataFrame
    citations: DataFrame
    authorships: DataFrame | None = None


class Graph(NamedTuple):
    """``vertices(id, ...)`` and ``edges(src, dst, weight, ...)``.

    Both may carry ``graph_id``; then every operator works on all graphs at
    once and never mixes them.
    """

    vertices: DataFrame
    edges: DataFrame


def graph_keys(df: DataFrame) -> list[str]:
    """``["graph_id"]`` when ``df`` holds many graphs, else ``[]``."""
    return [GRAPH_ID] if GRAPH_ID in df.columns else []
