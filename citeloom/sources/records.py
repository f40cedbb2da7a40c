"""Paper records in: JSON under the fixed schema, batch or per string column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_papers
from ..schema import PAPER_SCHEMA, Corpus


def read_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON-lines files as paper records; the schema is never inferred."""
    return spark.read.schema(PAPER_SCHEMA).json(path)


def parse_json(strings: DataFrame, column: str = "value") -> DataFrame:
    """A string column of JSON as paper records.

    Permissive like the file reader: unusable text or JSON ``null`` gives an
    all-null record, an unusable field gives null, unknown keys are ignored.
    """
    record = F.from_json(F.col(column), PAPER_SCHEMA)
    return strings.select(record.alias("record")).select("record.*")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Paper records stored as Parquet."""
    return spark.read.schema(PAPER_SCHEMA).parquet(path)


def explode_references(records: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` citations of records that are unique by ``paperId``.

    Repeats can only occur inside one record, so removing them from the array
    needs no shuffle. Null and empty lists give no row, null entries neither.
    """
    cited = F.explode(F.array_distinct("references.paperId"))
    return (
        records.select(F.col("paperId").alias("src"), cited.alias("dst"))
        .where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    )


def explode_authors(records: DataFrame) -> DataFrame:
    """``(paperId, authorId, name)`` of records that are unique by ``paperId``."""
    return (
        records.select("paperId", F.inline(F.array_distinct("authors")))
        .where(F.col("paperId").isNotNull() & F.col("authorId").isNotNull())
    )


def corpus_from_records(records: DataFrame, unique: bool = False) -> Corpus:
    """Normal form of nested records; set ``unique`` when ids do not repeat."""
    papers = records if unique else dedup_papers(records)
    slim = papers.drop("references", "citations", "authors")
    return Corpus(slim, explode_references(papers), explode_authors(papers))


def corpus_from_tables(papers: DataFrame, citations: DataFrame, authorships: DataFrame | None = None) -> Corpus:
    """Corpus from tables that are flat already; ``papers`` must be unique by ``paperId``."""
    known = F.col("src").isNotNull() & F.col("dst").isNotNull()
    pairs = citations.select("src", "dst").where(known).distinct()
    return Corpus(papers, pairs, authorships)


def attach_embeddings(papers: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Papers with vectors from a separate ``(paperId, vector)`` table."""
    vectors = embeddings.select(
        "paperId",
        F.struct(
            (F.col("model") if "model" in embeddings.columns else F.lit(None).cast("string")).alias("model"),
            F.col("vector").cast("array<double>").alias("vector"),
        ).alias("embedding"),
    )
    return papers.drop("embedding").join(vectors, "paperId", "left")
