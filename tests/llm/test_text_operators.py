"""Decontamination, curriculum, chat templates, URL filter and revisits against brute force and by case."""

import hashlib
import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.llm import chat_template, curriculum, decontaminate, queries, url_filter, warc

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- decontamination ----------------------------------------------------------


def brute_contamination(docs, items):
    out = []
    windows = []
    for item, text in items:
        w = words(text)
        n = min(len(w), 13)
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, gram in windows:
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i : i + len(gram)]) == gram:
                    hit.update(range(i, i + len(gram)))
                    if item is not None:
                        found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def contaminated(spark):
    rng = random.Random(2)

    def text(n):
        return " ".join(rng.choice(["Ab", "éa", "ÉA", "x1", "the", "\u212aw", "İz", "q"]) + rng.choice(["", "", ",", "z"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 3, 13, 14, 30]))) for i in range(8)]
    items += [(None, text(15)), (20, items[2][1]), (21, items[2][1].upper()), (22, ""), (23, None), (24, "...")]
    docs = [(i, f"{text(40)} {rng.choice(items)[1] or ''} {text(rng.choice([5, 300]))}") for i in range(30)]
    docs += [docs[3], (None, docs[4][1]), (50, None), (51, ""), (52, "?!"), (53, items[4][1])]
    frames = (spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, w string, found int"),
              spark.createDataFrame(items, "item_id long, text string"))
    return docs, items, *frames


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 600])
def test_contamination(contaminated, block_bytes):
    docs, items, df, benchmark = contaminated
    found = [tuple(r) for r in decontaminate.contamination(df, benchmark, block_bytes=block_bytes).collect()]
    assert sorted(found, key=str) == brute_contamination(docs, items)


def test_final_sigma_before_a_separator(spark):
    rest = " ".join(f"w{k}" for k in range(11))
    benchmark = spark.createDataFrame([(1, f"ΟΔΟΣ ΑΒ {rest}")], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"ΟΔΟΣ{sign}ΑΒ {rest}") for k, sign in enumerate(" .:'")], "doc_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, benchmark).collect()] == [13] * 4


def test_decontaminate(contaminated):
    docs, items, df, benchmark = contaminated
    kept = decontaminate.decontaminate(df, benchmark)
    assert kept.columns == df.columns
    want = [r[0] for r in brute_contamination(docs, items) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    cut = decontaminate.decontaminate(df, benchmark, remove="spans").collect()
    assert len(cut) == len(docs)
    n_hit = {(r[0], r[1]): r[2] for r in brute_contamination(docs, items)}
    for r in cut:
        before = next(t for i, t in docs if i == r.doc_id)
        assert len(words(r.text)) == len(words(before)) - n_hit[r.doc_id, len(words(before))]
    assert decontaminate.contamination(df, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(df.limit(0), benchmark).count() == 0


# --- curriculum ---------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / total for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
            free.discard(s)


@pytest.mark.parametrize("bucket_rows", [3, 1024])
def test_mix(spark, bucket_rows):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "c", "d", "é", None]) if i % 3 else "hot", "w " * rng.randrange(0, 40), 1, 2) for i in range(300)]
    rows += [rows[0], rows[0], (None, "a", None, 1, 2), (None, "tiny", "one two", 1, 2), (900, "empty", None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int, target int")
    found = curriculum.mix(docs, bucket_rows=bucket_rows).collect()
    assert len(found) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[1]] = sizes.get(r[1], 0) + len((r[2] or "").split())
    want = brute_targets(sizes)
    taken = {}
    for r in found:
        assert r.target == pytest.approx(want[r.source], abs=1e-6) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: round(t) for s, t in want.items()}
    again = curriculum.mix(docs, bucket_rows=bucket_rows).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_training_sequence(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * 10) for i in range(60)], "doc_id long, source string, text string")
    mixed = curriculum.mix(docs)
    rows = curriculum.training_sequence(mixed).collect()
    assert sum(r.n_words for r in rows) == sum(r.taken for r in mixed.collect())
    places = [r.position for r in rows]
    assert places == sorted(places) and 0 < places[0] and places[-1] < 1
    early = [r.n_words for r in rows if r.source == "a" and r.position < 0.5]
    late = [r.n_words for r in rows if r.source == "a" and r.position >= 0.5]
    assert sum(late) > 1.5 * sum(early)  # the first source rises from 0.5 to 1.5: 3/8 against 5/8
    assert curriculum.mix(docs.limit(0)).count() == 0
    assert curriculum.training_sequence(curriculum.mix(docs.limit(0))).count() == 0


def test_schedule_of_many_knots(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * 10) for i in range(200)], "doc_id long, source string, text string")
    knots = "array<struct<t:double,w:double>>"
    plan = spark.createDataFrame(
        [("a", [(0.0, 0.0), (0.5, 0.0), (1.0, 2.0)]), ("b", [(0.0, 1.0), (1.0, 1.0)])], f"source string, knots {knots}")
    rows = curriculum.training_sequence(curriculum.mix(docs, plan)).collect()
    assert min(r.position for r in rows if r.source == "a") > 0.5
    assert {s: sum(r.n_words for r in rows if r.source == s) for s in "ab"} == {"a": 667, "b": 1333}


# --- chat templates -----------------------------------------------------------


@given(st.text(alphabet="\\<|im_start>[/INST]s x\n"))
def test_escape_is_reversible_and_leaves_no_control(text):
    safe = chat_template.escape(text)
    assert chat_template.unescape(safe) == text
    assert not any(c in safe for c in chat_template.CONTROLS)


@given(st.lists(st.tuples(st.text(max_size=8), st.text(max_size=20)), max_size=5))
def test_round_trip(turns):
    turns = [*turns, ("assistant", "</s>[INST] ok [/INST]\\"), ("assistant", "<|im_end|>")]
    text, spans = chat_template.compile_template(chat_template.TEMPLATE, chat_template.CONSTANTS)(
        [{"role": r, "text": t} for r, t in turns])
    assert chat_template.read_turns(text) == turns
    assert chat_template.read_loss(text, spans) == "".join(t for r, t in turns if r == "assistant")


def test_folding():
    body = chat_template.fold(chat_template.parse("a{{ 'b' + bos | upper }}{% if 1 == 2 %}x{% elif not false %}c{% else %}{{ y }}{% endif %}"), {"bos": "z"})
    assert body == [("text", "abZc")]
    body = chat_template.fold(chat_template.parse("{% for m in messages %}{% set bos = m.text %}{{ bos }}{% endfor %}"), {"bos": "z"})
    assert body[0][2][1] == ("value", ("name", "bos"))


@pytest.mark.parametrize("source", ["{{ f(1) }}", "{{ m['x'] }}", "{{ m.__class__ | run }}", "{% while 1 %}", "{% for m in messages %}",
                                    "{% endif %}", "{{ 'a }}", "{{ }}", "{% if 1 %}{% else %}{% else %}{% endif %}"])
def test_what_the_language_has_not(source):
    with pytest.raises(chat_template.TemplateError):
        chat_template.parse(source)


def test_keys_are_not_attributes():
    render = chat_template.compile_template("{% for m in messages %}[{{ m.__class__ }}{{ m.text.upper }}{{ m.no.where }}]{% endfor %}")
    assert render([{"text": "a"}])[0] == "[]"


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "user", "n"), (3, None, "assistant", "z"),
            (3, 0, "assistant", "y"), (3, 0, "assistant", "x"), (4, 0, "assistant", "l" * 200_000)]
    df = spark.createDataFrame([(*r, 5, "t") for r in rows], "conv_id long, turn long, role string, text string, formatted int, loss string")
    found = {r.conv_id: r for r in chat_template.format_conversations(df).collect()}
    turns = {c: chat_template.read_turns(r.formatted) for c, r in found.items()}
    assert turns == {1: [("user", "a"), ("assistant", "b")], 2: [("", "")], None: [("user", "n")],
                     3: [("assistant", "z"), ("assistant", "x"), ("assistant", "y")], 4: [("assistant", "l" * 200_000)]}
    assert [found[3].formatted[s.start : s.stop] for s in found[3].loss_spans] == ["z", "x", "y"]
    assert chat_template.format_conversations(df.limit(0)).count() == 0


# --- url filter ---------------------------------------------------------------


def test_judge(spark):
    urls = ["http://www.EXAMPLE.com/en/x?q", "https://blog.example.com/en/", "http://example.com", "http://a.net/es/1#f", "x.net/fr/",
            "http://porn.org/", "http://pornography.org/", "http://x.org/cheap-pill/loan", "http://x.org/free", "http://free.org/free/win",
            "http://badexample.com/en/", "http://x.org/poker_bet", None, "", "://", "http://u@h.org:80/p://q"]
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    found = url_filter.judge(df, queries.URL_RULES).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in found] == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), (None, "allow"), ("net/es/", "block"), (None, "allow"),
        (None, "block"), (None, "allow"), (None, "block"), (None, "allow"), (None, "allow"),
        ("com/", "allow"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("www.example.com/en/", "allow")]
    assert [(r.host, r.path) for r in found][2:4] == [("example.com", ""), ("a.net", "/es/1")]
    assert [(r.host, r.path) for r in found][12:16] == [("", ""), ("", ""), ("", ""), ("u@h.org:80", "/p://q")]
    assert url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0
    bare = url_filter.judge(df, {}, url_filter.Vocabulary((), ())).collect()
    assert {r.verdict for r in bare} == {"allow"} and len(bare) == 17


# --- revisits -----------------------------------------------------------------


def test_canonical_url(spark):
    urls = {"HTTP://WWW.Ex.com:80/a/?b=2&utm_source=x&a=1#f": "ex.com/a?a=1&b=2", "https://ex.com": "ex.com", "ex.com/?": "ex.com",
            "http://ex.com/A?ref=1": "ex.com/A", "": ""}
    df = spark.createDataFrame([(u,) for u in [*urls, None]], "url string").select(warc.canonical_url(F.col("url")).alias("k"))
    assert [r.k for r in df.collect()] == [*urls.values(), None]


@pytest.mark.parametrize("bucket_seconds", [10, warc.BUCKET_SECONDS])
def test_revisits(spark, bucket_seconds):
    def record(i, url, at, kind, status, digest=None, **headers):
        return (i, url, at, kind, status, digest, {k.replace("_", "-"): v for k, v in headers.items()} or None, "extra")

    rows = [
        record(1, "http://a.b/x", 100, "response", 200, "d1", etag='"1"', date="1", content_length="9"),
        record(2, "http://a.b/x#f", 200, "response", 200, "d2", etag='"2"', last_modified="m", server="s"),
        record(3, "http://a.b/x", 200, "response", 206, "part"),
        record(4, "https://www.a.b/x", 200, "revisit", 304, None, etag='W/"1"', date="2", set_cookie="c", content_length="0"),
        record(5, "http://a.b/x", 201, "revisit", 304, None, etag='"1"'),
        record(6, "http://a.b/x", 9999, "revisit", 304, None, last_modified="m", expires="e"),
        record(7, "http://a.b/x", 100, "revisit", 304, None, etag='"1"'),
        record(8, None, 300, "revisit", 304), record(9, "http://a.b/x", None, "revisit", 304), record(10, "http://n.o/", 5, "revisit", 304),
        record(11, "http://a.b/x", 300, "revisit", 304, "d2"), record(12, "http://a.b/x", 300, "revisit", 304),
        record(13, "http://t.t/", 7, "response", 200, "t1"), record(14, "http://t.t/", 7, "response", 200, "t2"),
        record(15, "http://t.t/", 8, "revisit", 304), record(15, "http://t.t/", 8, "revisit", 304),
    ]
    schema = "record_id long, url string, s long, kind string, status int, digest string, headers map<string,string>, key string"
    df = spark.createDataFrame(rows, schema).withColumn("captured_at", F.timestamp_seconds("s"))
    found = sorted((r.record_id, r.ref_record_id, r.outcome, r.digest) for r in warc.resolve_revisits(df, bucket_seconds).collect())
    assert found == [
        (4, 1, "resolved", "d1"), (5, 2, "mismatch", None), (6, 2, "resolved", "d2"), (7, None, "unresolved", None),
        (8, None, "unresolved", None), (9, None, "unresolved", None), (10, None, "unresolved", None),
        (11, 2, "resolved", "d2"), (12, 2, "unchecked", "d2"), (15, 14, "unchecked", "t2"), (15, 14, "unchecked", "t2")]
    merged = {r.record_id: r.headers for r in warc.resolve_revisits(df, bucket_seconds).collect()}
    assert merged[4] == {"etag": 'W/"1"', "date": "2", "content-length": "9"}
    assert merged[6] == {"etag": '"2"', "last-modified": "m", "server": "s", "expires": "e"}
    assert merged[5] is None
    assert warc.resolve_revisits(df.limit(0)).count() == 0
