"""Words, hashes and the rule ledger against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from citeloom.llm import rule_ledger, scan

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab c\n\té#|.", max_size=60)), max_size=6)


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_spans_and_hashes_match_words(texts):
    data, offsets = scan.text_bytes(pa.array(texts, pa.string()))
    starts, ends, row = scan.spans(data, offsets, scan.SPACE)
    found = [(int(r), bytes(data[s:e]).decode()) for s, e, r in zip(starts, ends, row)]
    assert found == [(i, w) for i, t in enumerate(texts) for w in words(t)]
    hashes = scan.hashes(data, starts, ends)
    assert len({h for h in hashes.tolist()}) == len({w for _, w in found})


def test_hash_does_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(scan, "PIECE", 64)
    long = "x" * 300
    column = pa.array([f"one two {long} one", f"{long} one", "z " * 90 + "two"])
    data, offsets = scan.text_bytes(column)
    starts, ends, _ = scan.spans(data, offsets, scan.SPACE)
    by_word = {}
    for s, e, h in zip(starts, ends, scan.hashes(data, starts, ends).tolist()):
        assert by_word.setdefault(bytes(data[s:e]), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_slices_cover_all_rows_and_leave_long_texts_alone():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (3, 50, 0, 4, 4, 4)]), pa.array(range(6))], names=["text", "k"])
    parts = list(scan.slices(batch, "text", 10))
    assert [r for p in parts for r in p.column(1).to_pylist()] == list(range(6))
    assert [p.num_rows for p in parts][:2] == [1, 1]


def test_short_rows_have_one_shingle():
    h = np.arange(1, 10, dtype=np.uint64)
    row = np.array([0, 0, 0, 1, 1, 3, 3, 3, 3])
    made, owner = scan.shingles(h, row, 4, 3)
    assert owner.tolist() == [0, 1, 3, 3]
    assert len(set(made.tolist())) == 4


def brute(text):
    t = text or ""
    w = words(t)
    lines = [line for line in t.split("\n") if words(line)]
    triples = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_measures(texts):
    found = rule_ledger.measure_batch(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in found.items()} == brute(t)


def test_ledger_policies_and_ablations(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, good, "x"), (1, good, "x"), (2, None, "y"), (None, "", None), (4, "### " * 60, "z"), (5, good + "\n" + "$$$ " * 60, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, failed string")
    ledger = rule_ledger.ledger(docs)
    kept = [(r.doc_id, r.kept) for r in rule_ledger.apply_policy(ledger).collect()]
    assert sorted(kept, key=str) == sorted([(1, True), (1, True), (2, False), (None, False), (4, False), (5, False)], key=str)
    table = {r.rule: r.asDict() for r in rule_ledger.ablations(ledger, "v1").collect()}
    assert table["few_words"]["n_failed"] == 2 and table["few_words"]["n_kept_without"] == 4
    assert table["symbols"]["n_failed"] == 2
    assert rule_ledger.ledger(docs.limit(0)).count() == 0
    assert rule_ledger.ablations(rule_ledger.ledger(docs.limit(0))).first().n_kept_without == 0
