"""Connected components of an edge list, by alternating large and small stars.

A round turns every node towards the smallest node it knows, on larger neighbours
first, then on smaller ones; it ends when no edge changes, after a number of rounds
that grows with the logarithm of the size. Edges never become more, hubs are met by
aggregations and joins only, and each round continues from a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.storage import release, scratch_path


#: A narrow table is written by at most so many tasks per core of the cluster, so small partitions don't become small files.
TASKS_PER_CORE = 8
#: Bytes of an Arrow batch that goes to a Python worker while a table is written.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, label: str, narrow: bool = True) -> DataFrame:
    """``df`` as a table in the shared folder; lost executors don't lose it.

    ``narrow`` tables hold ids and numbers only; tables made from texts keep their own tasks.
    Batches to Python workers are kept small meanwhile, as long texts make rows large.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        few = df.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism) if narrow else df
        few.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    table = spark.read.parquet(path)
    table.scratch = path
    return table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    turned = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return turned.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(found)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``; the root is the smallest node of its component."""
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(ordered, "edges")
    before, after = None, _print(now)
    while before != after and after[0]:
        last, now = now, written(_small_star(_large_star(now)), "edges")
        release(last)
        before, after = after, _print(now)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
