"""Text cleaning, tokens and per-row term counts."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Collection

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word characters are letters, numbers and underscore. Java's (?U)\w also takes
# combining marks, so the classes are spelled out.
WORD = r"[\p{L}\p{N}_']+"
TERM = r"[\p{L}\p{N}_]{2,}"
# (?U)\s leaves out U+001C..U+001F, which count as white space here.
SPACES = r"(?U)[\s\x1C-\x1F]+"


@F.pandas_udf(T.StringType())
def _compose_and_unescape(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda t: html.unescape(unicodedata.normalize("NFKC", t)), na_action="ignore"
    )


def clean_text(text: Column) -> Column:
    """NFKC, entities, tags, white space, space before punctuation; empty becomes null.

    Spark has no Unicode normal form or entity expression, so those two steps are an
    Arrow function. It gets null, and does nothing, for rows that are plain ASCII
    without an ampersand.
    """
    raw = text.cast("string")
    affected = F.when(raw.rlike(r"[^\x00-\x7F]|&"), raw)
    stripped = F.regexp_replace(F.coalesce(_compose_and_unescape(affected), raw), "<[^>]+>", " ")
    spaced = F.trim(F.regexp_replace(stripped, SPACES, " "))
    return F.nullif(F.regexp_replace(spaced, " +([,.;:!?])", "$1"), F.lit(""))


def word_count(cleaned: Column) -> Column:
    """Number of words of cleaned text, whose only white space is single spaces."""
    return F.when(cleaned.isNotNull(), F.size(F.split(cleaned, " "))).otherwise(0)


def _lowered_matches(text: Column, pattern: str) -> Column:
    # Lowering the whole text first is the cheap way. Only U+0130 changes where its
    # words end when lowered, so texts with it lower each word afterwards.
    found = lambda t: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    exact = F.when(F.contains(text, F.lit("İ")), F.transform(found(text), F.lower)).otherwise(
        found(F.lower(text))
    )
    return F.when(text.isNotNull(), exact).otherwise(F.array().cast("array<string>"))


def tokenize(text: Column) -> Column:
    """Lower-case words, apostrophes included; null gives an empty array."""
    return _lowered_matches(text, WORD)


def terms(text: Column) -> Column:
    """Lower-case words of two characters and more, for the term matrix."""
    return _lowered_matches(text, TERM)


def is_one_of(value: Column, words: Collection[str]) -> Column:
    """Membership in a literal word list (an InSet for more than a few words)."""
    return value.isin(*sorted(words)) if words else F.lit(False)


def count_in(tokens: Column, words: Collection[str]) -> Column:
    """How many tokens, repeats included, are in the word list."""
    return F.size(F.filter(tokens, lambda t: is_one_of(t, words)))


def keep_candidates(tokens: Column, stopwords: Collection[str], min_length: int = 3) -> Column:
    """Tokens long enough to be a topic word and not stop words."""
    return F.filter(tokens, lambda t: (F.length(t) >= min_length) & ~is_one_of(t, stopwords))


def with_bigrams(words: Column) -> Column:
    """The words followed by each pair of neighbours joined by a space."""
    pairs = F.zip_with(
        words,
        F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)),
    )
    return F.concat(words, F.array_compact(pairs))


def run_starts(ordered: Column) -> Column:
    """Zero-based positions where a sorted array changes value."""
    positions = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(
        positions,
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def run_lengths(ordered: Column, starts: Column) -> Column:
    """(term, tf) pairs of a sorted array given its run starts."""
    return F.transform(
        starts,
        lambda s, j: F.struct(
            F.get(ordered, s).alias("term"),
            (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - s).alias("tf"),
        ),
    )


def snippet(text: Column, length: int = 280) -> Column:
    """The first characters of a text."""
    return F.substring(text, 1, length)
