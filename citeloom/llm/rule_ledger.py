"""Quality rules: a ledger of measurements and failure bits, and policies over it.

Every rule is evaluated once per document. The ledger keeps the measurements and
a bit mask of the rules that failed; a policy is a versioned mask of the rules that
reject, so a new policy, or its ablation, reads only the ledger. Ablations are sums
of bitwise tests in one pass, with map-side sums.

Words are ``[^\\x20\\x09-\\x0D]+``. Measured in whole texts with NumPy inside the
tasks: words and their code points, symbols ``#*$%&|<>``, repeated lines (lines
with a word, equal to an earlier one) and words in three-word windows that
are found twice or more.

Defined cases: null text measures like the empty text, which has no words and
fails ``few_words``; ratios of a text without words are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm import scan

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NO_BREAK = np.ones(256, bool)
_NO_BREAK[0x0A] = False


def rules() -> list[tuple[str, Column]]:
    """Name and failure condition; the place in this list is the bit. Append only."""
    n, words = F.col("n_words"), F.greatest(F.col("n_words"), F.lit(1))
    return [
        ("few_words", n < 50),
        ("repeated_windows", F.col("n_repeat_words") * 100 > n * 50),
        ("symbols", F.col("n_symbols") * 100 > n * 40),
        ("repeated_lines", F.col("n_dup_lines") * 100 > F.col("n_lines") * 60),
        ("word_length", (n > 0) & ((F.col("word_chars") > words * 25) | (F.col("word_chars") < words * 2))),
    ]


#: Versioned policies: the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length"),
}


def mask(names: tuple[str, ...]) -> int:
    places = {name: k for k, (name, _) in enumerate(rules())}
    return sum(1 << places[name] for name in names)


def measure_batch(column: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of a column of whole texts."""
    data, offsets = scan.text_bytes(column)
    n = len(offsets) - 1
    starts, ends, row = scan.spans(data, offsets, scan.SPACE)
    words = scan.hashes(data, starts, ends)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    out = {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": per_row(scan.SPACE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(_SYMBOL[data]),
    }
    line_starts, line_ends, line_row = scan.spans(data, offsets, _NO_BREAK)
    filled = np.searchsorted(starts, line_ends, "left") > np.searchsorted(starts, line_starts, "left")
    line_starts, line_ends, line_row = line_starts[filled], line_ends[filled], line_row[filled]
    _, again = scan.repeats(scan.hashes(data, line_starts, line_ends), line_row)
    out["n_lines"] = np.bincount(line_row, minlength=n)
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=n)
    windows = scan.runs_of(words, 3)
    own = np.flatnonzero(row[: len(windows)] == row[2:]) if len(windows) else np.zeros(0, np.int64)
    several, _ = scan.repeats(windows[own], row[own])
    hit = np.zeros(len(words), bool)
    first = own[several]
    for k in range(3):
        hit[first + k] = True
    out["n_repeat_words"] = np.bincount(row[hit], minlength=n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in scan.slices(batch, "text"):
            found = measure_batch(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(found[m]) for m in MEASURES]], names=["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements, and ``failed``, the bits of the failed rules."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = docs.select("doc_id", "text").mapInArrow(_measure, schema)
    bits = [F.when(bad, F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, bad) in enumerate(rules())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("long"))


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with ``kept`` under a policy."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """``(rule, n_failed, n_rejected_alone, n_kept_without)``: what each rule of a policy does."""
    whole = mask(POLICIES[policy])
    hit = F.col("failed").bitwiseAND(F.lit(whole))
    sums = [F.sum(F.when(hit == 0, 1).otherwise(0)).alias("kept")]
    for name in POLICIES[policy]:
        bit = mask((name,))
        sums.append(F.sum(F.when(hit.bitwiseAND(F.lit(bit)) != 0, 1).otherwise(0)).alias(f"f_{name}"))
        sums.append(F.sum(F.when(hit == bit, 1).otherwise(0)).alias(f"a_{name}"))
    total = rows.agg(*sums)
    each = F.array(*[
        F.struct(
            F.lit(name).alias("rule"), F.coalesce(f"f_{name}", F.lit(0)).cast("long").alias("n_failed"),
            F.coalesce(f"a_{name}", F.lit(0)).cast("long").alias("n_rejected_alone"),
            (F.coalesce("kept", F.lit(0)) + F.coalesce(f"a_{name}", F.lit(0))).cast("long").alias("n_kept_without"))
        for name in POLICIES[policy]])
    return total.select(F.inline(each))
