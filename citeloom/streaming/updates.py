"""Incremental graph updates from a stream of paper records.

Below ``path`` three tables grow, one folder per micro-batch: ``vertices``, the papers
that were new, ``citations``, all their references, and ``edges``. A reference whose
target is unknown waits in ``citations`` and is linked by the batch that brings the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_papers
from ..operators.edges import weigh
from ..schema import PAPER_SCHEMA
from ..sources.records import explode_references
from ..storage import cut_lineage, release, shuffles_removed

STREAM_SCHEMA = T.StructType([*PAPER_SCHEMA.fields, T.StructField("ingest_ts", T.TimestampType())])

_VERTEX = "id string, title string, year int, vector array<double>"
_CITATION = "src string, dst string"


def read_paper_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON-lines files of records with ``ingest_ts``, as they arrive."""
    reader = spark.readStream.schema(STREAM_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def _before(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """What earlier batches have stored; a retried batch does not see its own rows."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch_id int").parquet(path).where(F.col("batch_id") < batch_id).drop("batch_id")


def store_batch(
    batch: DataFrame, batch_id: int, path: str, vertices: DataFrame, citations: DataFrame | None = None
) -> None:
    """Store the new papers of one batch, their citations, and all edges they complete.

    ``vertices`` and ``citations`` are what the graph held before the stream;
    ``citations`` may name papers that only the stream brings. A paper that is
    known already adds nothing, however late it is sent again, so an edge is
    written once. Each batch owns one folder per table and replaces it when it
    is retried.
    """
    spark = batch.sparkSession
    known = vertices.select("id", "title", "year", "vector").unionByName(
        _before(spark, f"{path}/vertices", _VERTEX, batch_id))
    # Only what the graph keeps is shuffled and written, not the texts.
    arrived = dedup_papers(batch.drop("ingest_ts"), keep=["title", "year", "embedding", "references"])
    fresh = cut_lineage(arrived.join(known.select(F.col("id").alias("paperId")), "paperId", "left_anti"))
    added = fresh.select(F.col("paperId").alias("id"), "title", "year", F.col("embedding.vector").alias("vector"))
    cited = explode_references(fresh)
    waiting = _before(spark, f"{path}/citations", _CITATION, batch_id)
    if citations is not None:
        waiting = waiting.unionByName(citations.select("src", "dst").distinct())
    newly_linked = waiting.join(added.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst")
    # A citation is completed by the later of its two papers, so it is in one batch only.
    edges = weigh(cited.unionByName(newly_linked).distinct(), known.unionByName(added)).withColumn("edge_type", F.lit("citation"))
    with shuffles_removed(spark):
        for name, table in (("vertices", added), ("citations", cited), ("edges", edges)):
            table.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
    release(fresh)


def append_papers(
    stream: DataFrame, vertices: DataFrame, path: str, checkpoint: str, citations: DataFrame | None = None
) -> StreamingQuery:
    """Grow the graph below ``path`` by all available records, then stop.

    Records are told apart by the stored papers and not by a watermark, so
    none is dropped for being late.
    """
    return (
        stream.writeStream
        .foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, path, vertices, citations))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_appended_edges(spark: SparkSession, path: str) -> DataFrame:
    """All edges appended so far."""
    return spark.read.parquet(f"{path}/edges").drop("batch_id")


def read_appended_vertices(spark: SparkSession, path: str) -> DataFrame:
    """All papers appended so far."""
    return spark.read.parquet(f"{path}/vertices").drop("batch_id")
