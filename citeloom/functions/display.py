"""Display attributes of nodes and edges as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sizes, scale and counts the drawings are defined with.
TOP_SIZE = 20
PLAIN_SIZE = 10
EDGE_SCALE = 5.0
EDGE_FLOOR = 1.0
TOP_NODES = 10


def thickness(weight: Column, scale: float = EDGE_SCALE, floor: float = EDGE_FLOOR) -> Column:
    """Line width: scaled weight, never below the floor; null counts as 0."""
    return F.greatest(F.coalesce(weight, F.lit(0.0)) * F.lit(scale), F.lit(floor))


def weight_label(weight: Column) -> Column:
    """Weight with three decimals."""
    return F.format_string("%.3f", F.coalesce(weight, F.lit(0.0)))


def node_label(is_top: Column, title: Column, blank: str = " ") -> Column:
    """Title for top nodes, blank for the others."""
    return F.when(is_top, title).otherwise(F.lit(blank))


def node_size(is_top: Column) -> Column:
    return F.when(is_top, F.lit(TOP_SIZE)).otherwise(F.lit(PLAIN_SIZE))


def tooltip(title: Column, venue: Column | None = None, year: Column | None = None) -> Column:
    """Hover text: the title, with venue and year below it when given."""
    def text(part: Column) -> Column:
        return F.coalesce(part.cast("string"), F.lit(""))

    if venue is None or year is None:
        return text(title)
    return F.concat(text(title), F.lit("\n"), text(venue), F.lit(" ("), text(year), F.lit(")"))
