"""URL filter: explicit host rules, then a weighted vocabulary.

A url's host runs from after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A–Z lower-cased; its path goes on up to ``?``, ``#`` or the end. A rule such
as ``example.com/en/`` fits its host and all subdomains if the path starts with
the rule's path; the longest fitting rule decides. All other urls are judged by a
vocabulary: an Aho-Corasick automaton finds all terms in one pass, a term counts
if no letter or digit touches it, and a url is blocked by one strict term, or by
``min_soft`` distinct soft terms whose weights reach ``min_weight``.

Rules and vocabulary are short lists given by the caller and go to the tasks with
the function. Defined cases: a null url, or one without ``://``, has empty host and
path; a null url has no terms and is allowed; equal rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TOUCHES = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Vocabulary:
    """Strict terms, soft terms with their weights, and the limits for soft ones."""

    strict: tuple[str, ...]
    soft: tuple[tuple[str, int], ...]
    min_soft: int = 2
    min_weight: int = 3


VOCABULARY = Vocabulary(
    strict=("porn", "xxx", "viagra", "casino", "spam-farm", "cheap-pills", "adult-cams"),
    soft=(("cheap", 2), ("pills", 2), ("spam", 2), ("farm", 1), ("bet", 2), ("poker", 2), ("loan", 2), ("free", 1),
          ("win", 1), ("click", 1), ("deal", 1), ("utm_source", 1), ("ref", 1)),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(whole, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(whole, _PARTS, 2))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        at = rule.index("/") if "/" in rule else len(rule)
        own, start = rule[:at], rule[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if found is None else found


def term_counts(url: Column, vocabulary: Vocabulary) -> Column:
    """``struct(n_strict, n_soft, weight)`` of the distinct terms in each url."""

    @F.pandas_udf("n_strict int, n_soft int, weight int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        weights = dict(vocabulary.soft)
        for term in dict.fromkeys((*vocabulary.strict, *weights)):
            automaton.add_word(term, term)
        if len(automaton):
            automaton.make_automaton()
        strict = frozenset(vocabulary.strict)

        def terms(text: str) -> set[str]:
            found = set()
            if not len(automaton):
                return found
            for end, term in automaton.iter(text):
                start = end - len(term)
                if (start < 0 or text[start] not in _TOUCHES) and (end + 1 == len(text) or text[end + 1] not in _TOUCHES):
                    found.add(term)
            return found

        for urls in batches:
            rows = [terms(u) for u in urls]
            yield pd.DataFrame({
                "n_strict": [len(r & strict) for r in rows],
                "n_soft": [sum(t in weights for t in r) for r in rows],
                "weight": [sum(weights.get(t, 0) for t in r) for r in rows]}, dtype="int32")

    return count(F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER))


def judge(pages: DataFrame, rules: dict[str, str], vocabulary: Vocabulary = VOCABULARY, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, n_strict, n_soft, soft_weight``.

    A column of ``pages`` with one of these names is replaced.
    """
    host, path = host_and_path(F.col(url))
    terms = pages.withColumn("__terms", term_counts(F.col(url), vocabulary)).withColumns({"__host": host, "__path": path})
    rule = longest_rule(F.col("__host"), F.col("__path"), rules)
    blocked = (F.col("__terms.n_strict") > 0) | (
        (F.col("__terms.n_soft") >= vocabulary.min_soft) & (F.col("__terms.weight") >= vocabulary.min_weight))
    by_rule = None
    for name, verdict in rules.items():
        hit = F.col("__rule") == name
        by_rule = F.when(hit, verdict) if by_rule is None else by_rule.when(hit, verdict)
    by_terms = F.when(blocked, "block").otherwise("allow")
    made = {
        "host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__rule"),
        "verdict": by_terms if by_rule is None else by_rule.otherwise(by_terms),
        "n_strict": F.col("__terms.n_strict"), "n_soft": F.col("__terms.n_soft"), "soft_weight": F.col("__terms.weight"),
    }
    return terms.withColumn("__rule", rule).withColumns(made).drop("__host", "__path", "__rule", "__terms")
