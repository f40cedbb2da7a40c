"""Duplicate elimination on paper records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_papers(records: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """One record per ``paperId``, the same one on every run; null ids go.

    Preferred are records with an embedding, then with references, then the
    smallest title. Records are combined on the map side, so thousands of
    copies of one id never meet in one task, and every record passes through
    one shuffle at most. Equal copies of the winner are told apart by nothing
    and one of them stays. All columns decide which record stays; ``keep``
    names those that the caller reads, and no others are shuffled.
    """
    others = [c for c in records.columns if c != "paperId"]
    flags = [F.col(c).isNull().cast("tinyint") for c in ("embedding", "references") if c in others]
    title = F.col("title") if "title" in others else F.lit(None).cast("string")
    digest = F.xxhash64(title, F.xxhash64(*others))
    kept = [c for c in records.columns if keep is None or c == "paperId" or c in keep]
    rest = F.struct(*[c for c in kept if c not in ("paperId", "title")])
    # What follows the tie decides nothing: records that get there differ in no column.
    order = F.struct(*[f.alias(f"no_{i}") for i, f in enumerate(flags)], title.alias("title"), digest.alias("tie"), rest.alias("rest"))
    best = records.where(F.col("paperId").isNotNull()).select("paperId", order.alias("__order")).groupBy("paperId").agg(
        F.min("__order").alias("__best"))
    found = best.select("paperId", F.col("__best.title").alias("title"), "__best.rest.*")
    return found.select(*kept)
