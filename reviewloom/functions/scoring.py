"""Lexicon sentiment, aspect matches and rating buckets."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom import vocab
from reviewloom.functions.text import is_one_of

SENTIMENT_CUT = 0.05


def sentiment_score(positive: Column, negative: Column, token_count: Column) -> Column:
    """(positive - negative) per token, unrounded."""
    return (positive - negative) / F.greatest(token_count, F.lit(1))


def sentiment_label(positive: Column, negative: Column, score: Column) -> Column:
    """Label from the unrounded score; no hits at all is Neutral."""
    return (
        F.when((positive == 0) & (negative == 0), "Neutral")
        .when(score >= SENTIMENT_CUT, "Positive")
        .when(score <= -SENTIMENT_CUT, "Negative")
        .otherwise("Neutral")
    )


def vocabulary_hits(tokens: Column, aspects: Mapping[str, Collection[str]]) -> Column:
    """Distinct tokens that belong to any aspect."""
    every_term = frozenset().union(*aspects.values())
    return F.array_distinct(F.filter(tokens, lambda t: is_one_of(t, every_term)))


def aspect_matches(hits: Column, aspects: Mapping[str, Collection[str]]) -> Column:
    """One (aspect, matched_terms) struct per aspect that has a hit, in aspect order."""
    rows = [
        F.struct(
            F.lit(name).alias("aspect"),
            F.array_join(
                F.array_sort(F.array_intersect(hits, F.array(*map(F.lit, sorted(words))))), ","
            ).alias("matched_terms"),
        )
        for name, words in aspects.items()
    ]
    return F.filter(F.array(*rows), lambda row: row["matched_terms"] != "")


def mining_bucket(rating: Column) -> Column:
    """Basket item for a rating: up to 2 low, exactly 3 mid, every other value high."""
    return F.when(rating <= 2, "rating_low").when(rating == 3, "rating_mid").when(
        rating.isNotNull(), "rating_high"
    )


def dashboard_bucket(rating: Column) -> Column:
    """Rating group for charts: [0,2], (2,3], (3,5]; anything else is null."""
    low, mid, high = vocab.DASHBOARD_BUCKETS
    return (
        F.when((rating >= 0) & (rating <= 2), low)
        .when((rating > 2) & (rating <= 3), mid)
        .when((rating > 3) & (rating <= 5), high)
    )
