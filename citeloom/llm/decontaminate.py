"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

A–Z are lower-cased, words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Every
13 consecutive words of a benchmark item are a window; an item of fewer words,
but not none, is one window.

Documents are scanned once, by column functions, without a shuffle. The longest
word of each window is its anchor. A document word is looked up in a bit set of all
anchor hashes; only around a hit the windows are hashed and looked up in a bit set of
all window hashes. The few windows left are written out with their words, joined to
the broadcast windows, and count only where the words are equal. Bit sets give no false
miss, and their false hits end at that join. Inside the scan words are folded to lower case
in all scripts, which keeps their number and places and can only add candidates.

The windows are handled in blocks of at most ``block_bytes``, so what is
broadcast is bounded whatever the benchmark; each block reads the documents once.

Defined cases: a null text has no words and is clean; an item without words has
no window; items of equal words are one passage with several ids; a repeated
row gets its own, equal result; an empty benchmark hits nothing; null item ids
hit words but are not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.graphs import written

WINDOW = 13
#: Words hit out of all words, from which a document counts as contaminated.
SHARE = 20
BLOCK_BYTES = 8 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """All words, in their own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP), "")


def _folded(words: Column) -> Column:
    """Lower case word by word: that of a sigma depends on what stands beside it, also behind a separator."""
    return F.transform(words, lambda w: F.lower(w))


def _exact(words: Column) -> Column:
    return F.translate(F.array_join(words, " "), _UPPER, _LOWER)


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``(l, gram, passage, h, anchor)``: each distinct window of each distinct passage."""
    passages = benchmark.select(_exact(words_of(F.col("text"))).alias("line")).where("line <> ''").distinct()
    split = passages.select(F.split("line", " ").alias("w"), F.md5("line").alias("passage"))
    length = F.least(F.size("w"), F.lit(WINDOW))
    grams = split.select(
        "passage", length.alias("l"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))).alias("g"))
    folded = grams.select("passage", "l", F.array_join("g", " ").alias("gram")).distinct().withColumn(
        "f", _folded(F.split("gram", " ")))
    longest = F.array_max(F.transform("f", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    return folded.select("l", "gram", "passage", F.xxhash64("f").alias("h"), F.xxhash64(longest).alias("anchor"))


def _bit_set(values: DataFrame, bits: int) -> Column:
    """A bit set of 64-bit hashes as a constant array; at most ``bits`` rows reach the driver."""
    held = values.select(F.col(values.columns[0]).bitwiseAND(F.lit(bits - 1)).alias("b")).distinct().collect()
    longs = [0] * (bits // 64)
    for row in held:
        longs[row["b"] >> 6] |= 1 << (row["b"] & 63)
    signed = (v - (1 << 64) if v >> 63 else v for v in longs)
    return F.split(F.lit(",".join(map(str, signed))), ",").cast("array<bigint>")


def _found(bit_set: Column, bits: int, h: Column) -> Column:
    place = h.bitwiseAND(F.lit(bits - 1))
    return F.getbit(F.get(bit_set, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1


def _candidates(words: str, length: int, anchors: Column, grams: Column, bits: int) -> Column:
    """Starts (from 1) of windows of ``length`` words whose anchor and hash are in the bit sets."""
    last = F.size(words) - (length - 1)
    near = F.filter(
        F.transform(words, lambda x, i: F.when(_found(anchors, bits, F.xxhash64(x)), i + 1)), lambda i: i.isNotNull())

    def around(i: Column) -> Column:
        low, high = F.greatest(i - (length - 1), F.lit(1)), F.least(i, last)
        starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.filter(starts, lambda s: _found(grams, bits, F.xxhash64(F.slice(words, s, length))))

    return F.transform(F.array_distinct(F.flatten(F.transform(near, around))),
                       lambda s: F.struct(s.alias("p"), F.lit(length).alias("l")))


def _scan(docs: DataFrame, windows: DataFrame, lengths: list[int], count: int) -> DataFrame:
    """``(doc_id, row_key, n_words, found)``, written out: candidate windows with their words."""
    bits = 1 << max(12, (32 * count).bit_length())
    split = docs.select(
        "doc_id", F.col("text"), _folded(words_of(F.col("text"))).alias("w"),
        _row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    parts = [
        _candidates("w", n, _bit_set(windows.where(F.col("l") == n).select("anchor"), bits),
                    _bit_set(windows.where(F.col("l") == n).select("h"), bits), bits) for n in lengths]
    places = F.concat(*parts) if parts else F.array().cast("array<struct<p:int,l:int>>")
    marked = split.select("doc_id", "text", "row_key", F.size("w").cast("long").alias("n_words"), places.alias("places"))
    with_words = F.transform(F.array(words_of(F.col("text"))), lambda w: F.transform(
        "places", lambda c: F.struct(c["p"].alias("p"), c["l"].alias("l"), _exact(F.slice(w, c["p"], c["l"])).alias("gram"))))[0]
    return written(marked.select(
        "doc_id", "row_key", "n_words", F.when(F.size("places") > 0, with_words).alias("found")), "windows", narrow=False)


def hits(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(rows, hits)``: ``(doc_id, row_key, n_words)`` of each document, ``(row_key, spans, passages)`` of those hit."""
    windows = written(benchmark_windows(benchmark), "benchmark")
    # At most WINDOW rows.
    sized = windows.groupBy("l").agg(F.sum(F.length("gram") + 96).alias("bytes"), F.count("*").alias("n")).collect()
    lengths = sorted(r["l"] for r in sized)
    blocks = max(1, -(-sum(r["bytes"] for r in sized) // block_bytes))
    count = sum(r["n"] for r in sized) // blocks + 1
    rows = found = None
    for block in range(blocks):
        part = windows.where(F.pmod("h", F.lit(blocks)) == block) if blocks > 1 else windows
        scanned = _scan(docs, part, lengths, count)
        rows = scanned.select("doc_id", "row_key", "n_words") if rows is None else rows
        candidates = scanned.where("found IS NOT NULL").select("row_key", F.inline("found"))
        matched = candidates.join(F.broadcast(part.select("l", "gram", "passage")), ["l", "gram"]).select(
            "row_key", "p", "l", "passage")
        found = matched if found is None else found.unionByName(matched)
    return rows, found.groupBy("row_key").agg(
        F.collect_set(F.struct("p", "l")).alias("spans"), F.collect_set("passage").alias("passages"))


def _covered(spans: str) -> Column:
    """Positions of the words inside any span, each once."""
    return F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(s["p"], s["p"] + s["l"] - 1))))


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, words hit, items found, verdict.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.
    """
    rows, found = hits(docs, benchmark, block_bytes)
    ids = (
        benchmark.select(F.col("item_id").cast("string").alias("item"), _exact(words_of(F.col("text"))).alias("line"))
        .where("line <> ''").select("item", F.md5("line").alias("passage")).distinct()
    )
    listed = (
        found.select("row_key", F.size(_covered("spans")).cast("long").alias("n_hit"), F.explode("passages").alias("passage"))
        .join(ids, "passage", "left")
        .groupBy("row_key").agg(F.max("n_hit").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(listed, "row_key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                  share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated documents, or without their hit words.

    With ``remove="spans"`` each hit word goes with the separators before it,
    in every document that has one; the rest of the text stays as it is.
    """
    _, found = hits(docs, benchmark, block_bytes)
    hit = _covered("spans")
    marked = found.select(F.col("row_key").alias("__row_key"), hit.alias("__hit"))
    joined = docs.withColumn("__row_key", _row_key(F.col("doc_id"), F.col("text"))).join(marked, "__row_key", "left")
    n_words = F.size(words_of(F.col("text")))
    if remove == "documents":
        bad = F.col("__hit").isNotNull() & (F.size("__hit") * share >= n_words)
        return joined.where(~bad).select(*docs.columns)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    pieces = F.regexp_extract_all("text", F.lit(_RAW), F.lit(0))
    tail = F.regexp_extract("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$", 0)
    left = F.filter(pieces, lambda _, i: ~F.array_contains("__hit", i + 1))
    cleaned = F.when(F.col("__hit").isNull(), F.col("text")).otherwise(F.concat(F.array_join(left, ""), tail))
    return joined.withColumn("text", cleaned).select(*docs.columns)
