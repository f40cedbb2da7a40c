"""Cross-tokenizer alignment against plain loops over the tokenizers' own results."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest

from citeloom.llm import token_align as ta
from citeloom.llm.queries import TOKENIZERS, op13_token_alignment
from tests.llm.test_queries import SF_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizers")


@pytest.fixture(scope="module")
def plain():
    """``text -> (a ids, b ids, groups)`` by whole-text encoding and a walk over both."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{TOKENIZERS}/{ta.A_FILE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/{ta.B_FILE}")
    with open(f"{TOKENIZERS}/{ta.A_FILE}", "rb") as f:
        a_spelled = ta.ByteBpe(f.read()).spelled

    def spell(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def run(text):
        if not text:
            return [], [], []
        x = a.encode(" " + text, add_special_tokens=False).ids
        y = b.encode(text)
        whole = (" " + text).encode()
        if b"".join(a_spelled[i] for i in x) != whole or b"".join(spell(i) for i in y) != whole:
            return [], [], []
        groups, i, j, p, q = [([], [])], 0, 0, 0, 0
        while i < len(x) or j < len(y):
            if p <= q and i < len(x):
                groups[-1][0].append(x[i])
                p += len(a_spelled[x[i]])
                i += 1
            else:
                groups[-1][1].append(y[j])
                q += len(spell(y[j]))
                j += 1
            if p == q:
                groups.append(([], []))
        return x, y, groups[:-1]

    return run


def expected(plain, texts):
    found = [plain(t) for t in texts]
    links = Counter((g[0][-1], g[1][-1]) for _, _, groups in found for g in groups)
    most = defaultdict(int)
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    rows = []
    for x, y, groups in found:
        pairs = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        rows.append((len(x), len(y), len(groups), len(pairs), sum(links[p] == most[p[1]] for p in pairs), sum(links[p] for p in pairs),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


def aligned(spark, texts, chunk=ta.CHUNK):
    pair = ta.Pair(spark, TOKENIZERS)
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, node string")
    table = ta.written_alignment(docs, pair, chunk)
    scored = ta.score_links(table, ta.link_counts(table, pair), pair).orderBy("doc_id").collect()
    assert [r.doc_id for r in scored] == list(range(len(texts)))
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in scored]


ODD = ["", None, " ", "  ", "a", "\n", "a  b\t c \n", "<s> </s> <unk> <|endoftext|> <0x41>", "U+2581 ▁ here", "ﬁ ligature", "é ́", "日本語の文章、です。また、",
       "İstanbul ß ẞ", " x　y z", "\x1c \x1f a", "don't we'll I'm 'tis", "😀👩‍👩‍👧 ok", "x\x00y", "ok ok", "ok ok", "123456 7.89", "   lead and trail   "]


def random_texts(seed, n):
    rng = random.Random(seed)
    parts = ["the", " ", " ", "  ", "thing", "ation", "'s", ",", ".", "\n", "Ä", "ü", "日本", "語", "0", "42", "\t", "<s>", "▁", "🙂", "-", "x" * 9, "não", "(", " "]
    return ["".join(rng.choice(parts[:-1] if rng.random() < 0.98 else parts) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_against_plain_loops(spark, plain):
    texts = ODD + random_texts(1, 300)
    assert aligned(spark, texts) == expected(plain, texts)


@pytest.mark.parametrize("chunk", [3, 17, 64])
def test_composed_ranges_equal_whole_texts(spark, plain, chunk):
    texts = ODD + [t.replace("▁", "") for t in random_texts(2, 80)] + ["no-blank," * 60, "word " * 300, "日本語、" * 100]
    assert aligned(spark, texts, chunk) == expected(plain, texts)


def test_composition_is_associative():
    with open(f"{TOKENIZERS}/{ta.A_FILE}", "rb") as f, open(f"{TOKENIZERS}/{ta.B_FILE}", "rb") as g:
        aligner = ta.Aligner(ta.ByteBpe(f.read()), ta.PieceBpe(g.read()))
    rng = random.Random(3)
    for text in [t for t in random_texts(4, 150) if t and "▁" not in t]:
        s = " " + text
        at = lambda k: len(s[:k].encode())
        parts = [next(aligner.fragments([s[a0:a1]], [at(a0)], [s[b0:b1]], [at(b0)])) for a0, a1, b0, b1 in ta.ranges(s, 7)]
        whole = aligner.finish(next(aligner.fragments([s], [0], [s], [0])))
        assert any(len(p.suffix.a) or len(p.suffix.b) or not p.cut for p in parts[:-1]) or len(parts) < 5
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [aligner.compose(parts[k], parts[k + 1])]
        done = aligner.finish(parts[0])
        assert done[:4] == whole[:4] and done[4].tolist() == whole[4].tolist()
        empty = aligner.compose(parts[0], ta.Fragment())
        assert aligner.finish(empty)[:4] == whole[:4]


def test_linked_tokens_end_alike(spark):
    pair = ta.Pair(spark, TOKENIZERS)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(random_texts(5, 100))], "doc_id long, text string")
    aligner = pair.aligner()
    counts = ta.link_counts(ta.align(docs, pair), pair).collect()
    assert counts
    for r in counts:
        a, b = aligner.a.spelled[r.a], aligner.b.spelled[r.b]
        assert a.endswith(b) or b.endswith(a)


def test_empty_table(spark):
    assert aligned(spark, []) == []


def test_long_stretches_without_blanks(spark, plain):
    texts = ["a" * 200_000, "1" * 70_000, " " * 70_000, "ab,c" * 40_000, "é" * 70_000]
    assert aligned(spark, texts) == expected(plain, texts)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_registered_query(spark, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op13_token_alignment(spark, SF_DIR).collect()
    found = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}
    ids = sorted(docs)
    assert len(rows) == len(docs)
    assert [found[i] for i in ids] == expected(plain, [docs[i] for i in ids])
