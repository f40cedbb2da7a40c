"""Cosine similarity of ``array<double>`` columns.

One meaning everywhere: null or empty vector, zero or NaN norm, or a null
element gives 0.0; vectors of unequal length use the common prefix for the
dot product and the full vectors for the norms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    """Euclidean norm; null when the vector or an element is null."""
    return F.sqrt(_sum(F.transform(vector, lambda x: x * x)))


def dot(a: Column, b: Column) -> Column:
    """Dot product over the common prefix."""
    def product(x: Column, y: Column) -> Column:
        return x * y

    shared = F.least(F.size(a), F.size(b))
    return _sum(
        F.when(F.size(a) == F.size(b), F.zip_with(a, b, product))
        .otherwise(F.zip_with(F.slice(a, F.lit(1), shared), F.slice(b, F.lit(1), shared), product))
    )


def _usable(length: Column) -> Column:
    # Spark sorts NaN above every number, so "> 0" alone would let it pass.
    return (length > 0) & ~F.isnan(length)


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity as one native expression.

    Pass norms that are already columns: on joined edges they then cost one
    pass per vertex instead of one per edge.
    """
    na = norm(a) if norm_a is None else norm_a
    nb = norm(b) if norm_b is None else norm_b
    ratio = F.when(_usable(na) & _usable(nb), dot(a, b) / (na * nb))
    return F.coalesce(ratio, F.lit(0.0))
