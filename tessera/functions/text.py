"""Token expressions over article text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .literals import string_array


def tokens(text: Column | str) -> Column:
    """Split on a single ASCII space only (tabs and newlines stay inside tokens).

    Matching is case-sensitive and punctuation stays attached, so ``the,``
    and ``the`` are different tokens.
    """
    return F.split(_col(text), " ", -1)


def mentions(text: Column | str, term: str) -> Column:
    """True when ``term`` is one of the space-separated tokens of ``text``."""
    return F.array_contains(tokens(text), F.lit(term))


def vocabulary_array(terms: Sequence[str]) -> Column:
    """The vocabulary as a literal ``array<string>`` (position = index + 1)."""
    return string_array(list(terms))


def mentioned_terms(text: Column | str, terms: Sequence[str]) -> Column:
    """Distinct vocabulary terms that occur as tokens of ``text``.

    One hash-set pass over the tokens, whatever the vocabulary size; a term
    that repeats in the text is reported once.
    """
    return F.array_intersect(tokens(text), vocabulary_array(terms))


def term_position(term: Column | str, terms: Sequence[str]) -> Column:
    """1-based position of ``term`` in the vocabulary; 0 when absent."""
    return F.array_position(vocabulary_array(terms), _col(term))


def check_vocabulary(terms: Sequence[str]) -> list[str]:
    """Reject empty or duplicated vocabularies (duplicates would double-count)."""
    terms = list(terms)
    if not terms:
        raise ValueError("vocabulary is empty")
    if len(set(terms)) != len(terms):
        raise ValueError("vocabulary contains duplicate terms")
    if any(not isinstance(t, str) or t == "" for t in terms):
        raise ValueError("vocabulary terms must be non-empty strings")
    return terms


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
