"""Not-modified revisits: the latest earlier full response of the same canonical url.

A server that answers 304 leaves a revisit record without a body. It is resolved by
an as-of join: same canonical url, strictly earlier capture time, full response
(status 200). Validators are then compared (ETag weakly, else Last-Modified, else
the payload digest), and the headers that a 304 may update are merged over the
stored ones.

The as-of join never gathers a url in one task. All records of a url and a moment
are one row first (equal moments have equal answers), a window runs inside a url's
time bucket, and a second one over its bucket totals. Revisits are then joined by url
and moment, and responses by their id; these joins can be split where a key is hot.

Defined cases: a null url or time is ``unresolved``; of several full responses at
one moment the largest ``record_id`` counts; a response at the revisit's own moment
isn't earlier; repeated rows are resolved each; null headers are no headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.graphs import written

#: What a 304 response may update in the stored headers.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't tell pages apart.
TRACKING = r"(^|&)(utm_[^=&]*|fbclid|gclid|ref)=[^&]*"
BUCKET_SECONDS = 6 * 3600

RECORD_COLUMNS = ("record_id", "url", "captured_at", "kind", "status", "digest", "headers")


def canonical_url(url: Column) -> Column:
    """Host lower-cased without ``www.`` and default port; no scheme, fragment, tracking or last slash; query sorted."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), TRACKING, "")
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.when(url.isNotNull(), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _latest_before(events: DataFrame, bucket_seconds: int) -> DataFrame:
    """``(key, captured_at, ref)`` for each moment of a url: the last full response before it."""
    moments = events.groupBy("key", "captured_at").agg(
        F.max(F.when(F.col("full"), F.col("record_id"))).alias("here"), F.max("revisit").alias("revisit"),
    ).withColumn("bucket", F.floor(F.unix_micros("captured_at") / (bucket_seconds * 1_000_000)))
    totals = moments.groupBy("key", "bucket").agg(
        F.max(F.when(F.col("here").isNotNull(), F.struct("captured_at", "here")))["here"].alias("last"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("key", "bucket", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("key", "bucket").orderBy("captured_at").rowsBetween(Window.unboundedPreceding, -1)
    local = moments.withColumn("local", F.last("here", ignorenulls=True).over(inside)).where("revisit")
    return local.join(carried, ["key", "bucket"], "left").select(
        "key", "captured_at", F.coalesce("local", "carried").alias("ref"))


def _bare_tag(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit record of ``records`` (:data:`RECORD_COLUMNS`, ``headers`` with lower-case names).

    Returns ``record_id, url_key, captured_at, ref_record_id, outcome, digest, headers``;
    outcome is ``resolved``, ``mismatch`` (a validator differs), ``unchecked`` (none on
    both sides) or ``unresolved`` (no earlier response). Merged headers and the digest are
    given where the outcome is ``resolved`` or ``unchecked``.
    """
    rows = records.select(*RECORD_COLUMNS).withColumn("key", canonical_url(F.col("url")))
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    events = rows.select("record_id", "key", "captured_at", full.alias("full"), (F.col("kind") == "revisit").alias("revisit"))
    latest = _latest_before(
        events.where("key IS NOT NULL AND captured_at IS NOT NULL AND (full OR revisit)"), bucket_seconds)
    revisits = rows.where("kind = 'revisit'").select(
        "record_id", "key", "captured_at", F.col("digest").alias("own_digest"), F.col("headers").alias("own"))
    # Written, so that Spark can split its join where very many revisits have one response.
    stored = written(rows.where(full).groupBy(F.col("record_id").alias("ref")).agg(
        F.max_by(F.struct("digest", F.col("headers").alias("stored")), F.coalesce("digest", F.lit(""))).alias("s")), "stored", narrow=False)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    # Rows without an earlier response all have a null key; the spread keeps them out of one task.
    spread = F.when(F.col("ref").isNull(), F.pmod(F.xxhash64("record_id"), F.lit(4096))).otherwise(0)
    joined = (
        revisits.join(latest, ["key", "captured_at"], "left").withColumn("spread", spread)
        .join(stored.withColumn("spread", F.lit(0).cast("long")), ["ref", "spread"], "left")
        .withColumn("own", F.coalesce("own", none)).withColumn("stored", F.coalesce("s.stored", none))
        .withColumn("digest", F.col("s.digest")))

    def same(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), a == b)

    valid = F.coalesce(
        same(_bare_tag(F.col("own")["etag"]), _bare_tag(F.col("stored")["etag"])),
        same(F.col("own")["last-modified"], F.col("stored")["last-modified"]),
        same(F.col("own_digest"), F.col("digest")))
    outcome = (F.when(F.col("ref").isNull(), "unresolved").when(valid.isNull(), "unchecked")
               .when(valid, "resolved").otherwise("mismatch"))
    update = F.map_filter("own", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("stored", lambda k, _: ~F.map_contains_key(update, k))
    usable = F.col("outcome").isin("resolved", "unchecked")
    return joined.withColumn("outcome", outcome).select(
        "record_id", F.col("key").alias("url_key"), "captured_at", F.col("ref").alias("ref_record_id"), "outcome",
        F.when(usable, F.col("digest")).alias("digest"), F.when(usable, F.map_concat(kept, update)).alias("headers"))


def header_lines(headers: str) -> Column:
    """``name: value`` lines, sorted."""
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
