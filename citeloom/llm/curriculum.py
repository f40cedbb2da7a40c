"""Mixing sources to target weights along a time-varying curriculum.

Each source has a piecewise linear weight schedule over the training time
0..1. Its integral is the source's weight. All words are shared by weight; a
target stops at ``max_repeats`` times its source's size, the excess is shared
again by weight until none is above (the level is found in closed form over the
sources sorted by size / weight).

Within a source, documents are laid out in a fixed pseudo-random order and
repeated until the target is reached, the last document in part. The place of a
document copy in its source's words is turned into a training time by inverting
the cumulative demand, the integral of the schedule; copies of all sources are then
range-sorted by that time.

Running sums never use one task per source: a source is cut into buckets of
about ``bucket_rows`` documents by a hash, sums run inside buckets, and over the
bucket totals. Only one row per source, and one per bucket, meet in a window.

Defined cases: null text has size 0 and takes 0 words; null source is a source
of its own, last in order; a source of size 0 has target 0; repeated rows count
each by themselves; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.graphs import written

MAX_REPEATS = 3
BUCKET_ROWS = 1024
_WORD = r"[^\x20\x09-\x0D]+"


def default_schedule(sources: DataFrame) -> DataFrame:
    """``(source, knots)``: weights 1, 2, 3 in turn by source name; every second source rises, the others fall.

    ``sources`` has one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = (place % 3 + 1).cast("double")
    first = F.when(place % 2 == 0, 0.5).otherwise(1.5)
    return sources.select("source", F.array(
        F.struct(F.lit(0.0).alias("t"), (weight * first).alias("w")),
        F.struct(F.lit(1.0).alias("t"), (weight * (2.0 - first)).alias("w"))).alias("knots"))


def _segments(knots: str) -> Column:
    """Knots to linear pieces with the integral before each."""
    pieces = F.zip_with(
        F.slice(knots, 1, F.size(knots) - 1), F.slice(knots, 2, F.size(knots) - 1),
        lambda a, b: F.struct(
            a["t"].alias("t0"), (b["t"] - a["t"]).alias("dt"), a["w"].alias("w0"), b["w"].alias("w1"),
            ((a["w"] + b["w"]) / 2 * (b["t"] - a["t"])).alias("area")))
    return F.transform(pieces, lambda p, i: F.struct(
        p["t0"].alias("t0"), p["dt"].alias("dt"), p["w0"].alias("w0"), p["w1"].alias("w1"), p["area"].alias("area"),
        F.aggregate(F.slice(pieces, 1, i), F.lit(0.0), lambda s, q: s + q["area"]).alias("before")))


def source_targets(sizes: DataFrame, schedule: DataFrame | None = None, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, n_docs, segments, weight, target)``, one row per source of ``sizes(source, size)``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = default_schedule(totals.select("source")) if schedule is None else schedule
    joined = totals.join(plan, totals["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    weighed = joined.withColumn("segments", _segments("knots")).withColumn(
        "weight", F.aggregate("segments", F.lit(0.0), lambda s, p: s + p["area"]))
    cap = (F.col("source_size") * max_repeats).cast("long")
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    level = (
        weighed.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("full", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(all_rows) - F.coalesce("full", F.lit(0))) / F.col("open"))
    )
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(all_rows)["level"]
    return level.withColumn("level", F.coalesce(first, F.lit(0.0))).select(
        "source", "source_size", "n_docs", "segments", "weight",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def sized(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``(doc_id, source, size, place)``: the narrow rows the mix works on."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD)).cast("long")
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size"))
    return docs.select("doc_id", "source", size.alias("size")).withColumn(
        "place", F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long"))


def mix(docs: DataFrame, schedule: DataFrame | None = None, max_repeats: int = MAX_REPEATS,
        seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document with what the mix takes of it.

    Returns ``doc_id, source, size, source_size, target, before, taken, segments``;
    ``before`` is the number of words of its source laid out before it.
    """
    rows = written(sized(docs, seed), "sized", narrow=False)
    targets = written(source_targets(rows, schedule, max_repeats), "targets").withColumnRenamed("source", "__source")
    buckets = F.greatest(F.ceil(F.col("n_docs") / bucket_rows), F.lit(1))
    placed = rows.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumn(
        "bucket", F.pmod("place", buckets))
    narrow = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.select(
        F.col("source").alias("__source"), F.col("bucket").alias("__bucket"),
        F.coalesce(F.sum("bucket_size").over(over), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    summed = placed.withColumn("in_bucket", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(
        starts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))
    wanted = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    before = F.col("bucket_start") + F.col("in_bucket")
    rest = wanted - passes * F.col("source_size")
    last = F.greatest(F.least(rest - before, F.col("size")), F.lit(0))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", before.alias("before"),
        (F.col("size") * passes + last).cast("long").alias("taken"), "segments")


def _time(segments: str, share: Column) -> Column:
    """The time by which ``share`` of a source's demand has been used."""
    total = F.aggregate(segments, F.lit(0.0), lambda s, p: s + p["area"])
    need = share * total
    piece = F.element_at(F.filter(segments, lambda p: p["before"] <= need), -1)
    y = F.least(need - piece["before"], piece["area"])
    slope = (piece["w1"] - piece["w0"]) / piece["dt"]
    root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + y * slope * 2, F.lit(0.0)))
    return F.when(y <= 0, piece["t0"]).otherwise(F.least(piece["t0"] + piece["dt"], piece["t0"] + y * 2 / (piece["w0"] + root)))


def training_sequence(mixed: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per document copy taken, range-sorted by its training time.

    ``mixed`` is the result of :func:`mix`; its ``carried`` columns are kept. A copy is
    ``n_words`` words of the document from its start; only the last copy of a source can be partial.
    """
    size, taken = F.col("size"), F.col("taken")
    copies = F.when(taken > 0, F.ceil(taken / size)).otherwise(0).cast("int")
    n_words = F.least(size, taken - F.col("copy") * size)
    middle = F.col("copy") * F.col("source_size") + F.col("before") + n_words / 2
    rows = mixed.where(taken > 0).select(
        "*", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    return rows.select(
        "doc_id", "source", "size", "copy", n_words.alias("n_words"),
        _time("segments", F.least(middle / F.col("target"), F.lit(1.0))).alias("position"), *carried,
    ).orderBy("position", "source", "doc_id", "copy")
