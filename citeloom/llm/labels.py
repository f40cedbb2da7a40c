"""Bounded, repeatable samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One of so many parts of the documents is held out of all learning.
PARTS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % PARTS == 0


def class_counts(labels: DataFrame, label: str) -> dict[int, int]:
    """Learnable documents by label, two rows at most."""
    rows = _learnable(labels, label).groupBy("y").count().collect()
    return {r["y"]: r["count"] for r in rows}


def _learnable(labels: DataFrame, label: str) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``per_class`` documents of each label, in no order.

    The ids with the smallest checksums are taken, so reruns agree. Texts above ``max_chars``
    are not learnt from. At most ``2 * per_class`` ids are broadcast; documents aren't shuffled.
    """
    place = F.md5(F.col("doc_id").cast("string"))
    known = _learnable(labels, label)
    picked = [known.where(F.col("y") == y).orderBy(place, "doc_id").limit(per_class) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).select(F.col("doc_id").alias("__id"), "y")
    short = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
    return short.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).drop("__id")
