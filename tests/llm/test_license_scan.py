"""Licence scans against a naive search, a recursive parser and DuckDB."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeloom.llm import license_scan as ls
from citeloom.llm.queries import op12_license_scan
from tests.llm.test_queries import SF_DIR
from tests.oracle import connect

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def naive_base(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in ls.BASE.items():
        p = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def parse_down(tokens):
    """The same grammar by recursive descent."""
    place = 0

    def level(n):
        nonlocal place
        if n == 4:
            token = tokens[place]
            place += 1
            if token == "(":
                inner = level(1)
                assert tokens[place] == ")"
                place += 1
                return inner
            return token.value()
        left = level(n + 1)
        while place < len(tokens) and tokens[place] == {1: "or", 2: "and", 3: "with"}[n]:
            place += 1
            if n == 3:
                place += 1
                left = max(left, (left + 0.9) / 2)
            else:
                right = level(n + 1)
                left = max(left, right) if n == 1 else min(left, right)
        return left

    return level(1)


def expression(rng, depth=3):
    names = ["MIT", "Apache-2.0", "GPL-2.0-or-later", "CC-BY-NC-4.0", "0BSD", "AGPL-3.0", "Own-1.0"]
    if depth == 0 or rng.random() < 0.3:
        name = rng.choice(names)
        return f"{name} WITH LLVM-exception" if rng.random() < 0.2 else name
    inner = f"{expression(rng, depth - 1)} {rng.choice(['AND', 'OR', 'and'])} {expression(rng, depth - 1)}"
    return f"({inner})" if rng.random() < 0.5 else inner


def test_shunting_yard_equals_recursive_descent():
    rng = random.Random(5)
    for _ in range(500):
        text = expression(rng)
        tokens = ls.tag_tokens(f" {text}".encode(), 0)
        assert ls.evaluate(tokens) == pytest.approx(parse_down(tokens)), text


@pytest.mark.parametrize("text", ["", "(MIT", "MIT)", "MIT OR", "AND MIT", "MIT WITH MIT", "LLVM-exception OR MIT", "()", "MIT ("])
def test_what_is_no_expression(text):
    with pytest.raises(ls.ExpressionError):
        ls.evaluate(ls.tag_tokens(text.encode(), 0))


def scan_rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    return {r.doc_id: r for r in ls.scan_licenses(docs).collect()}


CASES = {
    "Licensed under CC BY-NC 4.0.": (["cc-by"], ["cc-by", "cc-by-nc"], 0.2),
    "Either the MIT License or the Apache License, Version 2.0, applies.": (["apache", "mit"], ["apache", "mit"], 0.9),
    "The GNU General Public License, version 2, or (at your option) any later version, or the MIT license":
        (["gpl", "mit"], ["gpl", "mit"], 0.9),
    "GNU General Public License version 2 with the Classpath Exception": (["gpl"], ["classpath-exception", "gpl"], 0.65),
    "MIT license and GNU General Public License": (["gpl", "mit"], ["gpl", "mit"], 0.4),
    "MIT license. Much else is said here, and then: GNU Affero General Public License":
        (["mit"], ["agpl", "mit"], 0.35),
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nx": ([], ["apache", "gpl", "mit"], 0.9),
    "SPDX-License-Identifier: MIT This file is ours": ([], ["mit"], 0.9),
    "SPDX-License-Identifier: (MIT": ([], ["invalid-expression", "mit"], 0.9),
    "SPDX-License-Identifier:": ([], ["invalid-expression"], 0.3),
    "All rights reserved.": ([], ["all-rights-reserved"], 0.0),
    "with the LLVM exception": ([], [], 0.5),
    "apache\n\nLICENSE apache license": (["apache"], ["apache"], 0.9),
    "xmit license mit licenses": ([], [], 0.5),
    "": ([], [], 0.5),
    None: ([], [], 0.5),
}


def test_cases(spark):
    found = scan_rows(spark, CASES)
    for i, (text, (base, labels, score)) in enumerate(CASES.items()):
        row = found[i]
        assert (row.base_labels, row.labels) == (base, labels), text
        assert row.score == pytest.approx(score), text


def test_base_places_against_a_naive_search(spark):
    rng = random.Random(9)
    parts = ["mit", "MIT", "license", "License", "apache", "gnu", "general", "public", "cc", "by", "nc", "ärzte", "x", "\n", ",", " ", "-", "\u00a0", "1"]
    texts = [rng.choice(["", " "]).join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["mit license " * 20000, "x" * 300000 + " mit license", None, ""]
    found = scan_rows(spark, texts)
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == naive_base(text)
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1


@settings(max_examples=200, deadline=None)
@given(st.text("abM(T) \n-:.é", max_size=60))
def test_no_text_breaks_a_tag(text):
    raw = ("SPDX-License-Identifier" + text).encode()
    try:
        assert 0 <= ls.evaluate(ls.tag_tokens(raw, 23)) <= 1
    except ls.ExpressionError:
        pass


def test_many_tags_in_one_line_take_linear_time(spark):
    found = scan_rows(spark, ["SPDX-License-Identifier: MIT OR ( " * 50000, "mit license or " * 100000])
    assert found[0].labels == ["invalid-expression", "mit", "spdx-license-identifier"]
    assert found[1].n_base == 100000 and found[1].labels == ["mit"]


def test_empty_table(spark):
    assert scan_rows(spark, []) == {}


BASE_SQL = r"""
WITH d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), '  ') || ' ' AS w FROM documents),
p(phrase, label) AS (VALUES (' gnu  general  public  license ', 'gpl'), (' apache  license ', 'apache'), (' cc  by ', 'cc-by'), (' mit  license ', 'mit')),
c AS (SELECT doc_id, label, (length(w) - length(replace(w, phrase, ''))) // length(phrase) AS n FROM d, p)
SELECT doc_id, CAST(sum(n) AS BIGINT), coalesce(string_agg(label, ',' ORDER BY label) FILTER (n > 0), '') FROM c GROUP BY 1 ORDER BY 1"""


@pytest.mark.skipif(not __import__("os").path.isdir(SF_DIR), reason="no test tables")
def test_base_columns_against_sql(spark):
    rows = op12_license_scan(spark, SF_DIR).select("doc_id", "n_base", "base_labels").orderBy("doc_id").collect()
    with connect(SF_DIR) as con:
        assert [tuple(r) for r in rows] == con.execute(BASE_SQL).fetchall()
