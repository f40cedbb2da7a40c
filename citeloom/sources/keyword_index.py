"""An inverted index behind the keyword search, kept as Parquet tables in a shared folder.

``postings`` has a row for each word of each paper, ``(word, paperId, bucket, fields)``, sorted by word and
id, so a search for some words skips all row groups of others by their statistics. No text is
stored or read. ``papers`` lists the ids of each segment. ``blocks`` sums the postings up: for each word and bucket the number of papers, the smallest id and
the largest score one paper can get there. Buckets are ranges of ids, fixed when the index is
made, and ordered like them.

**Top k by early stopping.** The best score of a bucket is bounded by the blocks of the words asked for. Buckets are read in the order
of that bound, then of ids, four at first and four times as many in each round, until the k-th best hit beats
the bound of all that are left. Ties go by id, so even a search for one very frequent word reads its first buckets only.

**Updates.** A batch of papers is one more segment of each table, in a folder of its own that a retry replaces. A paper that is sent
again supersedes what earlier segments hold of it. :meth:`KeywordIndex.merge` makes one segment of all.

Scores and order are those of :func:`citeloom.sources.search.keyword_search`. Papers without an id are not
indexed. Of several rows of one id in a batch, the words of all count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import query_words, words
from ..schema import GRAPH_ID
from ..storage import cut_lineage, delete, release, shuffles_removed, sorted_groups
from .search import page

#: Ranges of ids that are read or skipped as a whole, and how many ids their bounds are drawn from.
BUCKETS, SAMPLED_IDS = 256, 1 << 14
#: Buckets read in the first round of a search, and by how much later rounds grow.
FIRST_BUCKETS, GROWTH = 4, 4

#: Bits of ``fields``.
TITLE, ABSTRACT = 1, 2

_POSTINGS = "word string, paperId string, bucket int, fields int"
_BLOCKS = "word string, bucket int, n long, first_id string, top int"
_SUPERSEDED = "paperId string"
_PAPERS = "paperId string"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _bucket(paper_id: Column, bounds: list[str], first: int = 0) -> Column:
    """How many bounds are not above the id, by halving."""
    if not bounds:
        return F.lit(first)
    half = len(bounds) // 2
    return F.when(paper_id < bounds[half], _bucket(paper_id, bounds[:half], first)).otherwise(
        _bucket(paper_id, bounds[half + 1:], first + half + 1))


def _words_of(column: str, bit: int) -> Column:
    found = F.coalesce(words(F.col(column)), F.array().cast("array<string>"))
    return F.transform(found, lambda word: F.struct(word.alias("word"), F.lit(bit).alias("fields")))


def _dealt(postings: DataFrame) -> DataFrame:
    """A row for each word of each paper, in ranges of both: rows that repeat meet there, without another shuffle.

    They are sorted once and meet as neighbours; a hash table would hold every row. ``first`` keeps the order relevant to the
    optimizer, an id has one bucket.
    """
    by = ["word", "paperId"]
    return postings.repartitionByRange(*by).sortWithinPartitions(*by).groupBy(*by).agg(
        F.first("bucket").alias("bucket"), F.bit_or("fields").alias("fields"))


class KeywordIndex:
    """The index below ``path``; :meth:`build` makes it, :meth:`update` adds to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        #: Buckets that the last search with a limit has read, and how many hold a word asked for.
        self.buckets_read = self.buckets_held = 0

    # --- writing ----------------------------------------------------------------

    def build(self, papers: DataFrame, buckets: int = BUCKETS) -> KeywordIndex:
        """Index all ``papers(paperId, title, abstract)``; an index below ``path`` is replaced.

        The bounds of the buckets are quantiles of at most ``SAMPLED_IDS`` ids. They shape the layout,
        not the results.
        """
        if _exists(self.spark, self.path):
            delete(self.spark, self.path)
        ids = papers.where(F.col("paperId").isNotNull()).select("paperId").distinct()
        some = sorted(r.paperId for r in ids.orderBy(F.xxhash64("paperId"), "paperId").limit(SAMPLED_IDS).collect())
        bounds = sorted({some[len(some) * k // buckets] for k in range(1, buckets)}) if some else []
        self.spark.createDataFrame([(b,) for b in bounds], "bound string").coalesce(1).write.parquet(f"{self.path}/bounds")
        self._write(papers, 0)
        return self

    def update(self, papers: DataFrame, batch: int) -> None:
        """Add a batch of papers, numbered from 1 on; what the index holds of the same ids is superseded."""
        if batch < 1:
            raise ValueError("batches are numbered from 1 on")
        sent = papers.where(F.col("paperId").isNotNull()).select("paperId").distinct()
        known = self._table("papers", _PAPERS).where(F.col("segment") < batch).select("paperId")
        with shuffles_removed(self.spark):
            sent.join(known, "paperId", "left_semi").write.mode("overwrite").parquet(f"{self.path}/superseded/segment={batch}")
        self._write(papers, batch)

    def merge(self, path: str) -> KeywordIndex:
        """The same index with one segment, below another path."""
        merged = KeywordIndex(self.spark, path)
        self.spark.read.schema("bound string").parquet(f"{self.path}/bounds").coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
        with shuffles_removed(self.spark):
            self._table("papers", _PAPERS).select("paperId").distinct().write.mode("overwrite").parquet(f"{path}/papers/segment=0")
        merged._store(self._live().select("word", "paperId", "bucket", "fields"), 0)
        return merged

    def _write(self, papers: DataFrame, segment: int) -> None:
        bounds = sorted(r.bound for r in self.spark.read.schema("bound string").parquet(f"{self.path}/bounds").collect())
        named = papers.where("paperId IS NOT NULL AND (title IS NOT NULL OR abstract IS NOT NULL)").select(
            "paperId", _bucket(F.col("paperId"), bounds).alias("bucket"), "title", "abstract")
        with shuffles_removed(self.spark):
            named.select("paperId").distinct().write.mode("overwrite").parquet(f"{self.path}/papers/segment={segment}")
        spoken = named.select("paperId", "bucket", F.inline(F.concat(_words_of("title", TITLE), _words_of("abstract", ABSTRACT))))
        self._store(spoken, segment)

    def _store(self, postings: DataFrame, segment: int) -> None:
        """Store rows ``(word, paperId, bucket, fields)`` as a segment, one for each word of each paper."""
        target = f"{self.path}/postings/segment={segment}"
        with shuffles_removed(self.spark), sorted_groups(self.spark):
            _dealt(postings).sortWithinPartitions("word", "paperId").write.mode("overwrite").parquet(target)
        stored = self.spark.read.schema(_POSTINGS).parquet(target)
        blocks = stored.groupBy("word", "bucket").agg(
            F.count(F.lit(1)).alias("n"), F.min("paperId").alias("first_id"), F.lit(1).alias("top"))
        with shuffles_removed(self.spark):
            blocks.repartitionByRange("word", "bucket").sortWithinPartitions("word", "bucket").write.mode("overwrite").parquet(
                f"{self.path}/blocks/segment={segment}")

    # --- reading ----------------------------------------------------------------

    def _table(self, name: str, schema: str) -> DataFrame:
        if not _exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], f"{schema}, segment int")
        return self.spark.read.schema(f"{schema}, segment int").parquet(f"{self.path}/{name}")

    def _live(self, wanted: Column | None = None) -> DataFrame:
        """The postings that count; ``wanted`` is a filter that reaches the scan."""
        postings = self._table("postings", _POSTINGS)
        if wanted is not None:
            postings = postings.where(wanted)
        if not _exists(self.spark, f"{self.path}/superseded"):
            return postings
        gone = self._table("superseded", _SUPERSEDED).groupBy("paperId").agg(F.max("segment").alias("since"))
        since = F.col("s.since")
        return postings.alias("p").join(
            gone.alias("s"), (F.col("p.paperId") == F.col("s.paperId")) & (F.col("p.segment") < since), "left_anti")

    def _blocks(self) -> DataFrame:
        return self._table("blocks", _BLOCKS)

    def _scored(self, asked: list[str], buckets: list[int] | None = None) -> DataFrame:
        wanted = F.col("word").isin(asked)
        if buckets is not None:
            wanted = wanted & F.col("bucket").isin(buckets)
        return self._live(wanted).groupBy("paperId").agg(F.count(F.lit(1)).cast("int").alias("score"))

    def search(self, keywords: str | Sequence[str], limit: int | None = None, offset: int = 0) -> DataFrame:
        """``(paperId, score)`` of every hit, or of ``limit`` hits from ``offset`` on, best first."""
        asked = query_words(keywords)
        order = [F.desc("score"), F.asc("paperId")]
        if not asked or limit is None:
            return page(self._scored(asked), order, limit, offset)
        bounds = (
            self._blocks().where(F.col("word").isin(asked)).groupBy("word", "bucket")
            .agg(F.max("top").alias("top"), F.min("first_id").alias("first_id"))
            .groupBy("bucket").agg(F.sum("top").alias("bound"), F.min("first_id").alias("first_id"))
            .orderBy(F.desc("bound"), "bucket").collect())  # a row per bucket
        done = min(FIRST_BUCKETS, len(bounds))
        k = limit + offset
        while True:
            hits = self._scored(asked, [r.bucket for r in bounds[:done]])
            last = hits.orderBy(*order).offset(max(k - 1, 0)).limit(1).collect() if done < len(bounds) else []
            left = bounds[done:]
            # A bucket that is left has a better hit only with a higher score, or the same and a smaller id.
            beaten = last and all((-r.bound, r.first_id) >= (-last[0].score, last[0].paperId) for r in left)
            if not left or beaten:
                self.buckets_read, self.buckets_held = done, len(bounds)
                return page(hits, order, limit, offset)
            done = min(done * GROWTH, len(bounds))

    def search_many(self, queries: DataFrame, limit: int | None = None) -> DataFrame:
        """``(graph_id, paperId, score)`` for a table ``queries(graph_id, terms)``: every hit, or the best ``limit`` of each query."""
        asked = queries.select(GRAPH_ID, F.explode(words(F.array_join("terms", " "))).alias("word")).distinct()
        if limit is None:
            return self._count(asked.join(self._live(), "word"))
        asked = cut_lineage(asked)
        bounds = (
            asked.join(self._blocks(), "word").groupBy(GRAPH_ID, "word", "bucket")
            .agg(F.max("top").alias("top"), F.min("first_id").alias("first_id"))
            .groupBy(GRAPH_ID, "bucket").agg(F.sum("top").cast("int").alias("bound"), F.min("first_id").alias("first_id")))
        by_bound = Window.partitionBy(GRAPH_ID).orderBy(F.desc("bound"), "bucket")
        waiting = cut_lineage(bounds.withColumn("place", F.row_number().over(by_bound)))
        best, done = None, 0
        size = FIRST_BUCKETS
        while True:
            now = waiting.where(f"place > {done} AND place <= {done + size}")
            found = self._count(asked.join(now.select(GRAPH_ID, "bucket"), GRAPH_ID).join(self._live(), ["word", "bucket"]))
            hits = found if best is None else best.unionByName(found)
            ranked = Window.partitionBy(GRAPH_ID).orderBy(F.desc("score"), F.asc("paperId"))
            placed = hits.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= limit)
            previous, best = best, cut_lineage(placed.drop("place"))
            done += size
            size = done * (GROWTH - 1)
            last = best.groupBy(GRAPH_ID).agg(
                F.count(F.lit(1)).alias("n"), F.max(F.struct((-F.col("score")).alias("score"), F.col("paperId"))).alias("last"))
            bound = F.struct((-F.col("bound")).alias("score"), F.col("first_id").alias("paperId"))
            rest = waiting.where(F.col("place") > done).join(last, GRAPH_ID, "left").where(
                (F.coalesce("n", F.lit(0)) < limit) | (bound < F.col("last")))
            kept = cut_lineage(rest.select(*waiting.columns))
            for table in (previous, waiting):
                if table is not None:
                    release(table)
            waiting = kept
            if waiting.isEmpty():
                release(waiting)
                release(asked)
                return best

    def _count(self, met: DataFrame) -> DataFrame:
        return met.groupBy(GRAPH_ID, "paperId").agg(F.count(F.lit(1)).cast("int").alias("score"))
