"""Column expressions over text: query terms, word sets, display strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\x0b\x0c"
_NON_LETTERS = r"[^\p{L}]+"


def parse_terms(text: Column) -> Column:
    """Comma-separated text to an array of trimmed, non-empty terms."""
    trimmed = F.transform(F.split(text, ",", -1), lambda term: F.btrim(term, F.lit(_BLANKS)))
    return F.filter(trimmed, lambda term: term != "")


def join_terms(terms: Column) -> Column:
    """Terms to the one-line query text."""
    return F.array_join(terms, " ")


def publication_query(publication: Column, year: Column) -> Column:
    """Publication and year to the one-line query text."""
    return F.concat_ws(" ", publication, year.cast("string"))


def words(text: Column) -> Column:
    """Distinct case-folded words; everything that is not a letter separates."""
    split = F.split(F.lower(text), _NON_LETTERS, -1)
    return F.array_distinct(F.filter(split, lambda word: word != ""))


def has_word(text: Column, word: str) -> Column:
    """Whether lower-case ``text`` holds ``word`` (letters only) as a whole word.

    The plain substring test rejects most texts before the pattern runs.
    """
    whole = F.lit(rf"(?<!\p{{L}}){word}(?!\p{{L}})")
    return F.contains(text, F.lit(word)) & F.rlike(text, whole)


def query_words(keywords: str | Sequence[str]) -> list[str]:
    """Distinct search words of a keyword list or comma-separated string.

    Same folding as :func:`words`: letters stay together, the rest separates.
    """
    text = keywords if isinstance(keywords, str) else " ".join(keywords)
    spaced = "".join(ch if ch.isalpha() else " " for ch in text.lower())
    return sorted(set(spaced.split()))


def venue_matches(venue: Column, publication: Column) -> Column:
    """Case-insensitive substring test; a null venue counts as empty text."""
    return F.contains(F.lower(F.coalesce(venue, F.lit(""))), F.lower(publication))
