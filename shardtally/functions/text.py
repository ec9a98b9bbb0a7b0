"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ignoring_case(text: Column, word: str) -> Column:
    """True if ``word`` occurs in ``text``, whatever the case (no Unicode normalisation)."""
    return F.lower(text).contains(word.lower())


def extract(text: Column, pattern: str) -> Column:
    """First group of the first match, NULL if there is none."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
