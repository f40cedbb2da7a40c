"""Near-duplicate classes and passages against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import compact_windows, dart_minhash
from citeloom.llm.graphs import components

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SCHEMA = "doc_id long, text string, node string, class_id int, n_chars long"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def cells(text):
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    return {(g, k) for g, n in Counter(grams).items() for k in range(n)}


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def frame(spark, texts):
    rows = [(i, t, "clash", 7, len(t) if t is not None else None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def brute_classes(rows):
    parent = {}

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    sets = {t: cells(t) for _, t in rows}
    texts = list(sets)
    for a, b in combinations(texts, 2):
        s = len(sets[a] & sets[b])
        if s and s >= 0.8 * (len(sets[a]) + len(sets[b]) - s) - 1e-9:
            parent[top(a)] = top(b)
    least = {}
    for i, t in rows:
        least.setdefault(top(t), []).append(i)
    return sorted((i, min(least[top(t)])) for i, t in rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for k in range(12):
        base = text_of(rng, rng.choice([4, 30, 120, 300]))
        out.append((len(out), base))
        out += [(len(out) + j, edited(rng, base, e)) for j, e in enumerate((0, 1, 2, 4))]
    crowd = text_of(rng, 100)
    out += [(len(out) + j, edited(rng, crowd, rng.randrange(5))) for j in range(40)]
    out += [(1000, ""), (1001, ""), (1002, "..."), (1003, "a a a a a a a a a a"), (1004, "A a a a a, a a a a a")]
    return out


def test_classes_equal_brute_force(spark, rows):
    found = dart_minhash.near_classes(frame(spark, rows), block=8).collect()
    assert sorted((r.doc_id, r.class_id) for r in found) == brute_classes(rows)


def test_block_comparison_finds_what_leaders_miss(spark):
    """Links that only the blocks can see: members that all fail with the leader."""
    rng = random.Random(5)
    sets = [np.unique(np.array([rng.randrange(10**9) for _ in range(50)], np.uint64)) for _ in range(3)]
    twin = np.sort(np.append(sets[1][:-2], [5, 6]).astype(np.uint64))
    assert dart_minhash.forest([*sets, twin], [b"a", b"b", b"c", b"d"], 0.8) == [(1, 3)]
    assert dart_minhash.forest([*sets, twin], [b"a", b"b", b"c", b"b"], 0.8) == []


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(3)
    shared, left, right = (rng.integers(1, 1 << 62, n).astype(np.uint64) for n in (60, 20, 40))
    cells_ = np.concatenate([shared, left, shared, right])
    row = np.repeat([0, 1], [80, 100])
    signature, has = dart_minhash.signatures(cells_, row, 3, 2000)
    assert has.tolist() == [True, True, False]
    assert abs((signature[0] == signature[1]).mean() - 0.5) < 0.05
    part = np.concatenate([np.ones(60), np.full(20, 0.5), np.ones(60), np.full(40, 0.25)])
    signature, _ = dart_minhash.signatures(cells_, row, 2, 2000, part)
    assert abs((signature[0] == signature[1]).mean() - 60 / 80) < 0.05


def test_keep_first_keeps_one_of_each_class(spark, rows):
    docs = frame(spark, [*rows, rows[0], rows[0]]).union(spark.createDataFrame([(None, None, None, None, None)] * 2, SCHEMA))
    kept = dart_minhash.keep_first(docs)
    assert kept.columns == docs.columns
    firsts = {c for _, c in brute_classes(rows)}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(firsts)


def test_empty_tables(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    assert dart_minhash.near_classes(none).count() == 0
    assert dart_minhash.keep_first(none).count() == 0
    assert compact_windows.passages(none).count() == 0
    assert compact_windows.remove_passages(none).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 30)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame([*path, *star, (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)}


def test_compact_windows_partition_all_long_subsequences():
    rng = np.random.default_rng(0)
    for n, least in ((40, 6), (25, 25), (10, 20), (30, 1)):
        values = rng.permutation(n).astype(np.uint64)
        windows = compact_windows.compact_windows(values, least)
        for i in range(n):
            for j in range(i + least - 1, n):
                holding = [c for a, c, b in windows if a <= i <= c <= j <= b]
                assert holding == [i + int(values[i : j + 1].argmin())]


def brute_repeats(rows, n=50):
    """Words of each document inside a run of ``n`` words that an earlier document has."""
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        grams = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
        out[i] = {k + j for k, g in enumerate(grams) if g in seen for j in range(n)}
        for g in grams:
            seen.setdefault(g, i)
    return out


@pytest.fixture(scope="module")
def passage_rows():
    rng = random.Random(9)
    passages = [text_of(rng, n) for n in (50, 55, 70, 140, 400)]
    line = text_of(rng, 30)
    out = []
    for i in range(60):
        parts = [text_of(rng, rng.randrange(5, 200)), line, text_of(rng, 40)]
        if i % 2:
            parts.insert(rng.randrange(3), rng.choice(passages))
        out.append((i, " ".join(parts)))
    out += [(200, text_of(rng, 3000) + " " + passages[2] + " " + text_of(rng, 900)), (201, passages[4]), (202, passages[4]),
            (203, ""), (204, passages[0].rsplit(" ", 1)[0])]
    return out


def test_passages_hold_all_exact_repeats(spark, passage_rows):
    found = {}
    for r in compact_windows.passages(frame(spark, passage_rows), block=8).collect():
        assert r.first_doc_id < r.doc_id
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.stop_word))
    want = {i: w for i, w in brute_repeats(passage_rows).items() if w}
    assert found.keys() == want.keys()
    assert all(want[i] <= found[i] for i in want)
    # The line of 30 words beside a long passage can belong to a near duplicate.
    assert all(len(found[i] - want[i]) <= 35 for i in want)


def test_near_passage_is_found_and_short_line_is_not(spark):
    rng = random.Random(4)
    passage, line = text_of(rng, 120), text_of(rng, 45)
    rows = [(1, f"{text_of(rng, 60)} {passage} {text_of(rng, 10)}"), (2, f"{text_of(rng, 20)} {edited(rng, passage, 2)} {text_of(rng, 90)}"),
            *[(10 + i, f"{text_of(rng, 50)} {line} {text_of(rng, 50)}") for i in range(5)]]
    found = compact_windows.passages(frame(spark, rows)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == {(2, 1)}
    assert sum(r.stop_word - r.start_word for r in found) > 70


def test_remove_passages(spark, passage_rows):
    docs = frame(spark, [*passage_rows, passage_rows[1], (None, None)])
    left = {}
    for r in compact_windows.remove_passages(docs).collect():
        left.setdefault(r.doc_id, []).append(r)
    gone = {}
    for r in compact_windows.passages(docs).collect():
        gone.setdefault(r.doc_id, set()).update(range(r.start_word, r.stop_word))
    for i, t in passage_rows:
        kept = [w for k, w in enumerate(words(t)) if k not in gone.get(i, ())]
        texts = [words(r.text) for r in left.get(i, [])]
        assert texts == ([kept] if kept or i not in gone else [])
    assert all(r.n_chars == len(r.text) for rs in left.values() for r in rs if r.text is not None)
    assert len(left[None]) == 1


def test_shared_passages_within_repeated_tokens():
    one = np.array([7] * 80, np.uint32)
    other = np.array([*range(100, 160), *[7] * 80, *range(200, 260)], np.uint32)
    assert compact_windows.shared_passages(one, other) == [(0, 80)]
    assert compact_windows.shared_passages(np.arange(40, dtype=np.uint32), other) == []


def test_cut_words_keeps_the_rest():
    assert compact_windows.cut_words("Ab, cd! éf gh.", [(1, 3)]) == "Ab, gh."
    assert compact_windows.cut_words(None, [(0, 1)]) is None
    assert compact_windows.cut_words("a b", []) == "a b"
    assert pa.array([compact_windows.cut_words("a b", [(0, 2)])]).to_pylist() == [""]


def test_centres_are_those_of_the_windows():
    rng = np.random.default_rng(1)
    for n in (5, 10, 35, 400):
        values = rng.permutation(n).astype(np.uint64) + np.uint64(1)
        want = sorted(c for _, c, _ in compact_windows.compact_windows(values, 10))
        assert compact_windows.centres(values, 10).tolist() == want
    assert len(compact_windows.centres(np.full(30, 7, np.uint64), 10)) == 30


def test_every_passage_with_one_edit_is_found(spark):
    """One word changed or inserted anywhere near the middle of 50, 60 or 80 words."""
    rng = random.Random(12)
    rows, want = [], set()
    for k, (n, change) in enumerate((n, change) for n in (50, 60, 80) for change in (0, 1) for _ in range(40)):
        w = text_of(rng, n).split(" ")
        at = n // 2 + rng.randrange(-3, 4)
        other = [*w[:at], f"e{rng.randrange(10**6)}", *w[at + change :]]
        for i, x in ((2 * k, w), (2 * k + 1, other)):
            rows.append((i, f"{text_of(rng, rng.randrange(5, 90))} {' '.join(x)} {text_of(rng, rng.randrange(5, 90))}"))
        want.add((2 * k + 1, 2 * k))
    found = compact_windows.passages(frame(spark, rows)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == want


def test_inserted_word_is_found_behind_a_leader_with_the_line_only(spark):
    rng = random.Random(21)
    for n in (60, 80):
        # The line is short of a passage, and document 1 leads all its keys.
        line, rest = text_of(rng, 28), text_of(rng, n - 28).split(" ")
        put = [*rest[:2], "inserted", *rest[2:]]
        rows = [(1, f"{text_of(rng, 40)} {line} {text_of(rng, 40)}"), (2, f"{text_of(rng, 30)} {line} {' '.join(rest)} {text_of(rng, 50)}"),
                (3, f"{text_of(rng, 70)} {line} {' '.join(put)} {text_of(rng, 20)}")]
        texts = compact_windows._contents(iter([pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows]), pa.array([bytes([r[0]] * 8) for r in rows]), pa.array([r[1] for r in rows])],
            names=["doc_id", "node", "text"])]))
        tokens = [np.frombuffer(t.as_py(), np.uint32) for b in texts for t in b.column("tokens")]
        first = np.intersect1d(np.intersect1d(tokens[0], tokens[1]), tokens[2])
        places = [int(np.flatnonzero(np.isin(t, first))[10]) for t in tokens]
        low = [max(p - compact_windows.WIDE, 0) for p in places]
        block = pa.table({
            "first": [1, 2, 3], "node": [b"1", b"2", b"3"], "unit": [1, 2, 3], "base": [0, 0, 0], "i": [0, 0, 0], "places": [[p] for p in places],
            "open": [[p] for p in places], "low": low,
            "tokens": [t[q : p + compact_windows.WIDE + 1].tobytes() for t, p, q in zip(tokens, places, low, strict=True)]})
        found = compact_windows._block_verified(block).to_pylist()
        assert {(r["unit"], r["source_unit"]) for r in found} == {(3, 2)}
        assert all(66 <= r["start"] + 4 and r["stop"] <= 70 + n + 1 for r in found)


def test_every_place_of_a_key_is_a_window(spark):
    """A line twice in a document; the second begins a passage that a document after the leader has."""
    rng = random.Random(33)
    rows, want = [], set()
    for k in range(12):
        line, rest = text_of(rng, 30 + k), text_of(rng, 40)
        a, b, c, d, e, f, g = (text_of(rng, 60) for _ in range(7))
        rows += [(100 * k, f"{a} {line} {b}"), (100 * k + 1, f"{c} {line} {rest} {d}"), (100 * k + 2, f"{e} {line} {f} {line} {rest} {g}")]
        want.add((100 * k + 2, 100 * k + 1))
    found = compact_windows.passages(frame(spark, rows)).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == want
    for r in found:
        size = 30 + r.doc_id // 100
        assert r.start_word <= 120 + size and r.stop_word >= 120 + 2 * size + 40
    tokens = np.tile(np.arange(30, dtype=np.uint64) + np.uint64(9), 4)
    key, _, _ = compact_windows.window_keys(tokens, [(0, 120)])
    assert max(Counter(key.tolist()).values()) > 2


def test_longer_passage_of_another_document_is_cut_to_its_edges(spark):
    rng = random.Random(51)
    rows, want = [], {}
    for k in range(60):
        passage, more, front = text_of(rng, 60), text_of(rng, 10 + k % 20), k % 2
        longer = f"{more} {passage}" if front else f"{passage} {more}"
        lead = rng.randrange(5, 90)
        rows += [(100 * k, f"{text_of(rng, 40)} {passage} {text_of(rng, 40)}"), (100 * k + 1, f"{text_of(rng, 50)} {longer} {text_of(rng, 30)}"),
                 (100 * k + 2, f"{text_of(rng, lead)} {longer} {text_of(rng, 70)}")]
        want[100 * k + 2] = range(lead, lead + 60 + 10 + k % 20)
    left = {i: set(w) for i, w in want.items()}
    for r in compact_windows.passages(frame(spark, rows)).collect():
        left.get(r.doc_id, set()).difference_update(range(r.start_word, r.stop_word))
    assert max(map(len, left.values())) < 10


def test_rare_places_lose_no_passage():
    """Against a comparison with every text, on texts that share lines, with passages that have missing words."""
    rng = np.random.default_rng(3)
    line = rng.integers(0, 1 << 32, 38, np.uint32)
    texts = []
    for k in range(60):
        body = rng.integers(0, 1 << 32, 160, np.uint32)
        at = rng.integers(0, 100)
        body[at : at + 38] = line
        if k and rng.random() < 0.5:
            source = texts[rng.integers(0, k)]
            start, to, n = rng.integers(0, 100), rng.integers(0, 100), rng.integers(40, 60)
            body[to : to + n] = source[start : start + n]
            body[to + rng.integers(0, n, rng.integers(0, 8))] = rng.integers(0, 1 << 32)
        texts.append(body)
    tokens, counts = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
    found = 0
    for i, x in enumerate(texts):
        rare = compact_windows._rare_places(counts[np.searchsorted(tokens, x)])
        for j, y in enumerate(texts):
            if i != j and compact_windows._dense(np.isin(x, y)):
                found += 1
                assert np.isin(x[rare], y).any()
    assert found > 20
    # Nothing but the line is shared: nothing is looked up.
    assert not len(compact_windows._rare_places(np.where(np.isin(np.arange(160), np.arange(60, 98)), 50, 1)))


def test_two_blocks_compare_only_windows_of_different_blocks():
    tokens = np.arange(137, dtype=np.uint32).tobytes()
    block = pa.table({
        "first": [1, 2, 3], "node": [b"1", b"2", b"3"], "unit": [1, 2, 3], "base": [0, 0, 0], "i": [0, 1, 1], "places": [[70], [70], [70]],
        "open": [[70], [70], [70]], "low": [2, 2, 2], "tokens": [tokens[:-4] + bytes([k, 0, 0, 9]) for k in range(3)]})
    found = compact_windows._block_verified(block).to_pylist()
    assert {(r["unit"], r["source_unit"]) for r in found} == {(2, 1), (3, 1)}
    alone = compact_windows._block_verified(block.slice(1)).to_pylist()
    assert {(r["unit"], r["source_unit"]) for r in alone} == {(3, 2)}


def test_a_line_many_times_in_each_text(spark):
    """Texts that repeat lines between their own words, some with a passage of an earlier one; every place is a window."""
    rng = random.Random(71)
    line, rows, want = text_of(rng, 24), [], {}
    for i in range(24):
        parts = [f"{text_of(rng, rng.randrange(8, 20))} {line}" for _ in range(30)]
        if i % 3 == 2:
            # Own words and lines of an earlier text, in a row.
            parts[10:10] = rows[i - 2][2][5:8]
            want[i] = i - 2
        rows.append((i, " ".join(parts), parts))
    found = compact_windows.passages(frame(spark, [r[:2] for r in rows]), block=4).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == set(want.items())


def test_last_comparison_has_few_tasks(spark):
    """A task per two blocks filled the executors outside their heap."""
    rows = spark.range(9000).select((F.col("id") % 3000).alias("key"), F.col("id").alias("unit"))
    tasks = compact_windows._blocked(rows, 64)
    assert tasks.count() == 9000
    assert tasks.rdd.getNumPartitions() <= compact_windows._TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_rows_of_the_last_comparison_grow_with_the_units(spark):
    """A line in very many unlike texts: dealt by rare tokens, none of them is compared; each pair of blocks was before."""
    rng = np.random.default_rng(8)
    line, copies = rng.integers(0, 1 << 32, 30, np.uint32), {}
    for m in (40, 160):
        rows = []
        for i in range(m):
            body = rng.integers(0, 1 << 32, 150, np.uint32)
            body[60:90] = line
            if i % 10 == 9:
                body[50:110] = np.frombuffer(rows[i - 3][-1], np.uint32)[50:110]
            rows.append((7, i, str(i).encode(), i, 0, [70], [70], 0, body.tobytes()))
        hoods = spark.createDataFrame(
            rows, "key long, unit long, node binary, first long, base long, places array<int>, open array<int>, low int, tokens binary")
        tasks = compact_windows._blocked(compact_windows._grouped(hoods, 8), 8).drop("key").cache()
        found = tasks.groupBy("task").applyInArrow(compact_windows._block_verified, compact_windows._FOUND).collect()
        assert {(r.unit, r.source_unit) for r in found} == {(i, i - 3) for i in range(9, m, 10)}
        copies[m] = tasks.count()
    assert copies[160] <= 4.5 * copies[40]


def test_few_open_units_of_a_large_group_meet_all_others_once(spark):
    rows = spark.range(1000).select(F.lit("k").alias("key"), F.col("id").alias("unit"), F.expr(
        "if(id % 100 = 0, array(1), cast(array() as array<int>))").alias("open"))
    tasks = compact_windows._blocked(rows, 50).select("task", "unit", "i", F.size("open").alias("o")).collect()
    # Each of the 990 once; the ten open ones with each of their 20 blocks and with themselves.
    assert len(tasks) == 990 + 10 * 21
    by_task = {}
    for r in tasks:
        by_task.setdefault(r.task, []).append(r)
    met = {(a.unit, b.unit) for rs in by_task.values() for a in rs if a.o for b in rs if a.unit != b.unit}
    assert len(met) == 10 * 999


def test_runs_of_one_word_are_compared_without_trying_every_offset(monkeypatch):
    """43 times one token is short of a passage, whatever the offset."""
    calls, aligned = [], compact_windows._aligned
    monkeypatch.setattr(compact_windows, "_aligned", lambda x, y, d: calls.append(d) or aligned(x, y, d))
    rng = np.random.default_rng(5)
    texts = []
    for i, n in enumerate((120, 127, 43)):
        body = rng.integers(0, 1 << 32, 160, np.uint32)
        body[:n] = 5
        texts.append(body)
    block = pa.table({
        "first": [1, 2, 3], "node": [b"1", b"2", b"3"], "unit": [1, 2, 3], "base": [0, 0, 0], "i": [0, 0, 0], "places": [[10], [10], [10]],
        "open": [[], [], [10]], "low": [0, 0, 0], "tokens": [t.tobytes() for t in texts]})
    assert compact_windows._block_verified(block).num_rows == 0
    assert not calls


def test_offsets_that_agree_are_kept():
    rng = np.random.default_rng(6)
    for _ in range(50):
        x, y = (rng.integers(0, 3, n).astype(np.uint32) * np.uint32(9) for n in (90, 140))
        a, b = rng.integers(0, 30), rng.integers(0, 80)
        y[b : b + 50] = x[a : a + 50]
        offsets = np.unique(rng.integers(-80, 130, 60).tolist() + [b - a])
        offsets = offsets[(offsets > -len(x)) & (offsets < len(y))]
        want = [p for d in offsets.tolist() for p in compact_windows._aligned(x, y, d)]
        assert want and compact_windows._at_offsets(x, y, offsets) == want


def test_rare_places_of_overlapping_passages_are_the_same_on_ties():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 1 << 32, 160, np.int64)
    df = np.full(160, 2)
    rare = compact_windows._rare_places(df, x)
    assert all(len(np.intersect1d(rare, np.arange(s, s + 46))) >= 6 for s in range(115))
    assert len(rare) < 45
