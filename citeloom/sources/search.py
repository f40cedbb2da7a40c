"""Paper selection from a corpus table: keyword, id, and venue + year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_word, query_words, venue_matches, words
from ..schema import GRAPH_ID

# Fixed value: the largest page that :func:`search_page` returns.
MAX_PAGE = 100
# Fixed value: how many hits a preview lists.
PREVIEW_ROWS = 5
#: Longer lists of typed-in ids are joined, shorter ones become a filter of the scan.
FILTER_IDS = 1000


def page(hits: DataFrame, order: Sequence[Column], limit: int | None, offset: int = 0) -> DataFrame:
    """``limit`` rows from ``offset`` on; without both every row, in no order."""
    if limit is None and not offset:
        return hits
    ordered = hits.orderBy(*order).offset(offset)
    return ordered if limit is None else ordered.limit(limit)


def _paper_text() -> Column:
    return F.concat_ws(" ", "title", "abstract")


def keyword_hits(papers: DataFrame, keywords: str | Sequence[str]) -> DataFrame:
    """Papers holding any search word in title or abstract; ``score`` counts distinct words."""
    text = F.lower(_paper_text())
    found = [has_word(text, word) for word in query_words(keywords)]
    if not found:
        return papers.withColumn("score", F.lit(0)).where(F.lit(False))
    score = reduce(add, [F.when(hit, 1).otherwise(0) for hit in found])
    return papers.where(reduce(or_, found)).withColumn("score", score)


def keyword_search(
    papers: DataFrame, keywords: str | Sequence[str], limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Every keyword hit, or the best ``limit`` of them; ties go by id."""
    return page(keyword_hits(papers, keywords), [F.desc("score"), F.asc("paperId")], limit, offset)


def search_page(
    papers: DataFrame, keywords: str | Sequence[str], limit: int = MAX_PAGE, offset: int = 0
) -> DataFrame:
    """One page of a search, of ``MAX_PAGE`` rows at most."""
    return keyword_search(papers, keywords, min(limit, MAX_PAGE), offset)


def keyword_hits_many(papers: DataFrame, queries: DataFrame, limit: int | None = None) -> DataFrame:
    """``(graph_id, paperId, score)`` for a table ``queries(graph_id, terms)``.

    Words meet query words in one equi-join. Top-k per query filters on the
    map side before its shuffle, so a query that matches a third of the
    corpus still sends only a page per task.
    """
    asked = queries.select(GRAPH_ID, F.explode(words(F.array_join("terms", " "))).alias("word")).distinct()
    spoken = papers.select("paperId", F.explode(words(_paper_text())).alias("word"))
    found = (
        spoken.join(asked, "word")
        .groupBy(GRAPH_ID, "paperId")
        .agg(F.count(F.lit(1)).cast("int").alias("score"))
    )
    if limit is None:
        return found
    best = Window.partitionBy(GRAPH_ID).orderBy(F.desc("score"), F.asc("paperId"))
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= limit).drop("place")


def search_preview(papers: DataFrame, keywords: str | Sequence[str]) -> DataFrame:
    """First five hits ``(position, title, year, id)`` and how many follow.

    Hits are counted by a scalar aggregate; only the five are numbered.
    """
    hits = keyword_hits(papers.select("paperId", "title", "abstract", "year"), keywords)
    total = hits.agg(F.count(F.lit(1)))
    best = [F.desc("score"), F.asc("paperId")]
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*best))
    return (
        hits.orderBy(*best).limit(PREVIEW_ROWS)
        .withColumn("position", position)
        .withColumn("n_more", F.greatest(total.scalar() - PREVIEW_ROWS, F.lit(0)))
        .select("position", "title", "year", F.col("paperId").alias("id"), "n_more")
    )


def _id_frame(papers: DataFrame, ids: DataFrame | Sequence[str]) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select("paperId").where(F.col("paperId").isNotNull()).distinct()
    return papers.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], "paperId string")


def lookup_ids(papers: DataFrame, ids: DataFrame | Sequence[str]) -> DataFrame:
    """Papers with the given ids; ids without a paper are left out.

    A short typed-in list becomes an ``IN`` filter that reaches the Parquet
    scan. Requested ids are made distinct on the map side before they shuffle.
    """
    if isinstance(ids, DataFrame) or len(set(ids)) > FILTER_IDS:
        return papers.join(_id_frame(papers, ids), "paperId", "left_semi")
    return papers.where(F.col("paperId").isin(sorted(set(ids))))


def missing_ids(papers: DataFrame, ids: DataFrame | Sequence[str]) -> DataFrame:
    """The requested ids that no paper has."""
    return _id_frame(papers, ids).join(papers.select("paperId"), "paperId", "left_anti")


def lookup_ids_strict(papers: DataFrame, ids: DataFrame | Sequence[str]) -> DataFrame:
    """Like :func:`lookup_ids`, but an unknown id is an error."""
    unknown = [row.paperId for row in missing_ids(papers, ids).limit(PREVIEW_ROWS).collect()]
    if unknown:
        raise LookupError(f"no paper for ids such as {unknown}")
    return lookup_ids(papers, ids)


def publication_search(
    papers: DataFrame, publication: str, year: int, limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Papers of one year whose venue contains ``publication`` in any case."""
    hits = papers.where((F.col("year") == year) & venue_matches(F.col("venue"), F.lit(publication)))
    return page(hits, [F.asc("paperId")], limit, offset)


def publication_hits_many(papers: DataFrame, queries: DataFrame) -> DataFrame:
    """Papers with ``graph_id`` for a table ``queries(graph_id, publication, year)``."""
    asked = queries.select(GRAPH_ID, "publication", "year")
    # Requests are matched to the distinct venues of their year; papers then meet equal keys only.
    venues = papers.select("venue", "year").distinct()
    named = venues.join(asked, "year").where(venue_matches(F.col("venue"), F.col("publication")))
    wanted = named.select(GRAPH_ID, F.col("venue").alias("asked_venue"), F.col("year").alias("asked_year")).distinct()
    same = F.col("venue").eqNullSafe(F.col("asked_venue")) & (F.col("year") == F.col("asked_year"))
    return papers.join(wanted, same).drop("asked_venue", "asked_year")
