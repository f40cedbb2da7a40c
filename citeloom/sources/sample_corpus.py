"""Paper corpus over the star-schema test tables.

A paper per order: year and references from the order and its lines, text and venue from the
document, vector from the embedding with the same number, where there is one. All rows of these
tables are read, and texts stay whole: the title is the first line, the short summary the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PAPER_SCHEMA, Corpus
from .records import corpus_from_tables

# The columns the corpus uses. A declared schema saves the job
# that would look for it in the files.
COLUMNS = {
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint",
    "supplier": "s_suppkey bigint, s_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _papers(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """Paper records without their lists and with their order's key, one row per paper.

    Without ``texts``, abstracts and short summaries are null, and documents shrink to their titles before they are shuffled.
    """
    vectors = table(spark, sf_dir, "embeddings")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = F.split("text", "\n")
    if not texts:
        documents = documents.select("doc_id", F.get(lines, 0).alias("title"), F.lit(None).cast("string").alias("text"), "source")
    return (
        orders.join(documents, F.col("doc_id") == F.col("o_orderkey"), "left")
        .join(vectors, F.col("vec_id") == F.col("o_orderkey"), "left")
        .select(
            "o_orderkey",
            F.col("o_orderkey").cast("string").alias("paperId"),
            F.get(lines, 0).alias("title") if texts else "title",
            F.col("text").alias("abstract"),
            F.col("source").alias("venue"),
            F.year("o_orderdate").alias("year"),
            F.struct(
                F.lit("fixture").alias("model"),
                F.col("embedding").cast("array<double>").alias("vector"),
            ).alias("embedding"),
            F.struct(F.element_at(lines, -1).alias("text")).alias("tldr"),
        )
    )


def sample_papers(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """Paper records without their lists, one row per paper."""
    return _papers(spark, sf_dir, texts).drop("o_orderkey")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")


def sample_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)`` rows, repeats included."""
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("src"), F.col("l_partkey").cast("string").alias("dst"))


def sample_authorships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(paperId, authorId, name)``, one row per paper and author."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name"))
    return (
        _lines(spark, sf_dir).select("l_orderkey", "l_suppkey").distinct()
        .join(suppliers, "l_suppkey", "left")
        .select(
            F.col("l_orderkey").cast("string").alias("paperId"),
            F.col("l_suppkey").cast("string").alias("authorId"),
            "name",
        )
    )


def sample_corpus(spark: SparkSession, sf_dir: str, authors: bool = False, texts: bool = True) -> Corpus:
    """The corpus in normal form; lists stay rows."""
    return corpus_from_tables(
        sample_papers(spark, sf_dir, texts),
        sample_citations(spark, sf_dir),
        sample_authorships(spark, sf_dir) if authors else None,
    )


def sample_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as nested records, for the operators that take those.

    A list is one cell of a record, so its length is bounded by what one
    order holds; everything else works on the normal form. The list of citing
    papers has no such bound, no operator reads it, and it stays null.
    Orders, documents, vectors and lists meet by number, so each is shuffled once.
    """
    lines = _lines(spark, sf_dir).where("l_orderkey IS NOT NULL")
    references = lines.where("l_partkey IS NOT NULL").groupBy("l_orderkey").agg(F.sort_array(F.transform(
        F.collect_set("l_partkey"), lambda part: F.struct(part.cast("string").alias("paperId")))).alias("references"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name"))
    # The distinct rows of an order stay where they are when nothing but a small table is joined.
    named = lines.select("l_orderkey", "l_suppkey").repartition("l_orderkey").distinct().join(suppliers, "l_suppkey", "left")
    authors = named.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("l_suppkey").cast("string").alias("authorId"), "name"))).alias("authors"))
    return (
        _papers(spark, sf_dir)
        .join(references.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
        .join(authors.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
        .withColumn("citations", F.lit(None).cast(PAPER_SCHEMA["citations"].dataType))
        .select("paperId", "title", "abstract", "venue", "year", "authors", "references", "citations",
                "embedding", "tldr")
    )
