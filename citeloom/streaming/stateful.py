"""A growing paper graph in keyed state: the cost of a batch follows the batch, not the graph.

Streaming queries, each with its own progress and exactly-once files:

* ``sent`` reduces each batch of records to the best one per paper id.
* ``papers`` keeps one flag per paper id. The first batch that brings an id stores its best record, later ones add nothing,
  however late they come: no watermark, so nothing expires.
* ``arrived`` reads the new papers as a stream, each once, and deals them out by the cited paper: a row for the paper itself and one for
  each ``BLOCK`` citations of a paper, with the vectors of the citing ones.
* ``edges`` is the join of both kinds of rows as streams. Its state is the rows that have come, by cited paper; the later of the
  two papers of a citation completes an edge, which is written once.

The graph held before the stream is the initial state of both, read by the first batch only. A paper that very many
others cite has many blocks, and the edges of each are made under one of ``salts`` keys. The stored papers and edges are never read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.vectors import cosine
from ..operators.dedup import dedup_papers
from ..operators.skew import hot_keys, salt_rows
from ..storage import cut_lineage, release, shuffles_removed

#: Over how many keys the edges of one paper are spread.
SALTS = 4
#: How many of a batch's citations of one paper are one row of the state, about.
BLOCK = 256

_PAPERS = "id string, title string, year int, vector array<double>, cited array<string>"
_EDGES = "src string, dst string, weight double, edge_type string"
_EVENTS = "id string, vector array<double>, citing array<struct<src string, vector array<double>>>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """State of this kind lives in RocksDB; a query keeps the setting it was started with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _write(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    with _rocks(rows.sparkSession):
        return (
            rows.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _unseen(spark: SparkSession, path: str, checkpoint: str) -> StreamingQuery:
    """Go on writing the papers of the folder ``sent`` whose ids have not come before; ended on return."""
    held = spark.readStream.schema("id string").parquet(f"{path}/first").withColumn("known", F.lit(True))
    sent = spark.readStream.schema(_PAPERS).parquet(f"{path}/sent").withColumn("known", F.lit(False))
    fresh = held.unionByName(sent, allowMissingColumns=True).dropDuplicates(["id"]).where(~F.col("known"))
    query = _write(fresh.select("id", "title", "year", "vector", "cited"), f"{path}/papers", f"{checkpoint}/papers")
    query.awaitTermination()
    return query


def store_new_papers(stream: DataFrame, vertices: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the papers of a record stream that neither ``vertices(id, ...)`` nor an earlier record has.

    All are written when this returns. Each batch is reduced to its best record per paper and then passes the state of ids
    on its own, so the first batch that brings an id wins. A batch that is sent there again, after a failure, finds its ids known.
    The result is the ended query that keeps this state.
    """
    spark = stream.sparkSession
    _once(vertices.where("id IS NOT NULL").select("id").distinct(), f"{path}/first")
    _folder(spark, f"{path}/sent")
    # The known ids, and what a failure has left, come before any record of this call.
    last = [_unseen(spark, path, checkpoint)]

    def send(batch: DataFrame, _: int) -> None:
        best = dedup_papers(batch.drop("ingest_ts"), keep=["title", "year", "embedding", "references"])
        with shuffles_removed(batch.sparkSession):
            best.select(
                F.col("paperId").alias("id"), "title", "year", F.col("embedding.vector").alias("vector"),
                F.filter(F.array_distinct("references.paperId"), lambda x: x.isNotNull()).alias("cited"),
            ).write.mode("append").parquet(f"{path}/sent")
        last[0] = _unseen(spark, path, checkpoint)

    (stream.writeStream.foreachBatch(send).option("checkpointLocation", f"{checkpoint}/sent")
     .trigger(availableNow=True).start().awaitTermination())
    return last[0]


def _folder(spark: SparkSession, path: str) -> None:
    """Make a folder that a stream reads, if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def _complete(spark: SparkSession, folder: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _once(rows: DataFrame, folder: str) -> None:
    """Store what the graph held before its first batch; a folder that is complete stays as it is."""
    if not _complete(rows.sparkSession, folder):
        with shuffles_removed(rows.sparkSession):
            rows.write.mode("overwrite").parquet(folder)


def _blocks(cited: DataFrame) -> DataFrame:
    """Rows ``(src, dst, vector)`` as events, a row for about ``BLOCK`` citations of a paper; ``cited`` is a written table."""
    dealt = salt_rows(cited, hot_keys(cited, "dst", BLOCK), "dst", F.col("src"))
    return dealt.groupBy(F.col("dst").alias("id"), "salt").agg(F.collect_list(F.struct("src", "vector")).alias("citing")).select(
        "id", F.lit(None).cast("array<double>").alias("vector"), "citing")


def _targets(papers: DataFrame) -> DataFrame:
    return papers.select("id", "vector", F.lit(None).cast("array<struct<src string, vector array<double>>>").alias("citing"))


def store_completed_edges(
    spark: SparkSession, vertices: DataFrame, path: str, checkpoint: str, citations: DataFrame | None = None, salts: int = SALTS
) -> StreamingQuery:
    """Write all edges that the papers of :func:`store_new_papers` complete; all are written when this returns.

    ``citations(src, dst)`` are those of ``vertices``; the ones that name papers to come wait for them. The result is
    the ended query that has read the new papers.
    """
    known = vertices.where("id IS NOT NULL").select("id", "vector")
    if not _complete(spark, f"{path}/held"):
        held, ahead = _targets(known.dropDuplicates(["id"])), None
        if citations is not None:
            pairs = citations.select("src", "dst").where("dst IS NOT NULL").distinct()
            waiting = pairs.join(known.select(F.col("id").alias("dst")), "dst", "left_anti")
            ahead = cut_lineage(waiting.join(known.select(F.col("id").alias("src"), "vector"), "src").select("src", "dst", "vector"))
            held = held.unionByName(_blocks(ahead))
        _once(held, f"{path}/held")
        if ahead is not None:
            release(ahead)

    def deal(batch: DataFrame, batch_id: int) -> None:
        new = cut_lineage(batch.select("id", "vector", "cited"))
        cited = cut_lineage(new.select(F.col("id").alias("src"), F.explode("cited").alias("dst"), "vector"))
        with shuffles_removed(batch.sparkSession):
            _targets(new).unionByName(_blocks(cited)).write.mode("overwrite").parquet(f"{path}/arrived/batch_id={batch_id}")
        release(new)
        release(cited)

    _folder(spark, f"{path}/arrived")
    papers = spark.readStream.schema(_PAPERS).parquet(f"{path}/papers")
    arrived = (
        papers.writeStream.foreachBatch(deal).option("checkpointLocation", f"{checkpoint}/arrived")
        .trigger(availableNow=True).start())
    arrived.awaitTermination()

    def events(wanted: str) -> DataFrame:
        parts = [spark.readStream.schema(_EVENTS).option("recursiveFileLookup", True).parquet(f"{path}/{name}")
                 for name in ("held", "arrived")]
        return parts[0].unionByName(parts[1]).where(wanted)

    targets = events("citing IS NULL").select(F.col("id").alias("dst"), F.col("vector").alias("dst_vector"))
    blocks = events("citing IS NOT NULL").select(F.col("id").alias("dst"), "citing")
    met = blocks.join(targets, "dst").withColumn("salt", F.pmod(F.xxhash64(F.col("citing")[0]["src"]), F.lit(salts)))
    edges = met.repartition("dst", "salt").select("dst", "dst_vector", F.inline("citing")).select(
        "src", "dst", cosine(F.col("vector"), F.col("dst_vector")).alias("weight"), F.lit("citation").alias("edge_type"))
    _write(edges, f"{path}/edges", f"{checkpoint}/edges").awaitTermination()
    return arrived


def grow_graph(
    stream: DataFrame, vertices: DataFrame, path: str, checkpoint: str, citations: DataFrame | None = None, salts: int = SALTS
) -> None:
    """Grow the graph below ``path`` by all available records, then stop; called again, it goes on with what has come since."""
    store_new_papers(stream, vertices, path, checkpoint).awaitTermination()
    store_completed_edges(stream.sparkSession, vertices, path, checkpoint, citations, salts).awaitTermination()


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """All edges written so far."""
    return spark.read.schema(_EDGES).parquet(f"{path}/edges")


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """All papers written so far, with the ids they cite."""
    return spark.read.schema(_PAPERS).parquet(f"{path}/papers")
