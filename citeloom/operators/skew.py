"""Salting for layouts that are kept over many joins.

Ordinary joins need none of this: Spark splits their skewed partitions at run
time. It can't split a side that was laid out once and cached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with fewer rows than this is left to one task.
HOT_FLOOR = 500_000


def hot_keys(rows: DataFrame, key: str, floor: int = HOT_FLOOR) -> DataFrame:
    """``(key, fan)``: all keys with more than ``floor`` rows, and over how many tasks to spread them.

    Frequencies are counted with map-side combining. There are at most
    ``rows / floor`` such keys.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > floor).select(key, F.ceil(F.col("n") / floor).cast("int").alias("fan"))


def salt_rows(rows: DataFrame, hot: DataFrame, key: str, spread: Column) -> DataFrame:
    """Add ``salt``: 0 for ordinary keys, a hash of ``spread`` for hot ones."""
    salt = F.pmod(F.xxhash64(spread), F.coalesce("fan", F.lit(1))).cast("int")
    return rows.join(hot, key, "left").select(*rows.columns, salt.alias("salt"))


def salt_copies(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat rows with a hot key once per salt, so every salted row finds its match."""
    salts = F.sequence(F.lit(0), F.coalesce("fan", F.lit(1)) - 1)
    return rows.join(hot, key, "left").select(*rows.columns, F.explode(salts).alias("salt"))
