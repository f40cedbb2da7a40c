"""Paper-graph analytics as Spark DataFrame operators."""

from .schema import GRAPH_ID, PAPER_SCHEMA, Corpus, Graph

__all__ = ["GRAPH_ID", "PAPER_SCHEMA", "Corpus", "Graph"]
