"""Sentiment, aspects and frequent terms."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import vocab
from reviewloom.functions import scoring
from reviewloom.functions.rows import unnest
from reviewloom.functions.text import count_in, keep_candidates, tokenize


@dataclass(frozen=True)
class Lexicon:
    """The word lists that score a review."""

    positive: Collection[str] = vocab.POSITIVE_TERMS
    negative: Collection[str] = vocab.NEGATIVE_TERMS
    aspects: Mapping[str, Collection[str]] = field(default_factory=lambda: dict(vocab.ASPECT_TERMS))


def enrich(reviews: DataFrame, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """Score ``cleaned_text``; ``aspect_hits`` holds one struct per matched aspect.

    One pass without a shuffle. The token array is computed once per row and dropped.
    """
    tokens, score = F.col("_tokens"), F.col("_score")
    positive, negative = F.col("sentiment_positive_hits"), F.col("sentiment_negative_hits")
    return (
        reviews.withColumn("_tokens", tokenize(F.col("cleaned_text")))
        .withColumns(
            {
                "sentiment_positive_hits": count_in(tokens, lexicon.positive),
                "sentiment_negative_hits": count_in(tokens, lexicon.negative),
                "_token_count": F.size(tokens),
                "_hits": scoring.vocabulary_hits(tokens, lexicon.aspects),
            }
        )
        .withColumn("_score", scoring.sentiment_score(positive, negative, F.col("_token_count")))
        .withColumns(
            {
                "sentiment_label": scoring.sentiment_label(positive, negative, score),
                "sentiment_score": F.round(score, 6),
                "sentiment_method": F.lit(vocab.SENTIMENT_METHOD),
                "sentiment_status": F.lit("derived_unvalidated"),
                "aspect_hits": scoring.aspect_matches(F.col("_hits"), lexicon.aspects),
            }
        )
        .withColumn("aspect_count", F.size("aspect_hits"))
        .drop("_tokens", "_token_count", "_hits", "_score")
    )


def review_aspects(enriched: DataFrame) -> DataFrame:
    """One row per review and matched aspect; polarity is that of the whole review."""
    kept = ("review_id", "branch_id", "review_date", "sentiment_label", "sentiment_score")
    return unnest(enriched, "aspect_hits", "hit", *kept).select(
        "review_id",
        "branch_id",
        "review_date",
        "hit.aspect",
        "hit.matched_terms",
        F.col("sentiment_label").alias("aspect_sentiment_label"),
        F.col("sentiment_score").alias("aspect_sentiment_score"),
        F.lit(vocab.ASPECT_METHOD).alias("aspect_method"),
        F.lit("derived_unvalidated").alias("aspect_status"),
    )


def build_nlp(reviews: DataFrame, lexicon: Lexicon = Lexicon()) -> tuple[DataFrame, DataFrame]:
    """Enriched reviews and the aspect table, both from one lineage."""
    enriched = enrich(reviews, lexicon)
    return enriched.drop("aspect_hits"), review_aspects(enriched)


def term_frequencies(reviews: DataFrame, stopwords: Collection[str] = vocab.CANDIDATE_STOPWORDS) -> DataFrame:
    """Occurrences of every candidate term in the whole corpus."""
    words = keep_candidates(tokenize(F.col("cleaned_text")), stopwords)
    return unnest(reviews, words, "term").groupBy("term").agg(F.count("*").alias("document_term_count"))


def topic_candidates(
    reviews: DataFrame, limit: int = 30, stopwords: Collection[str] = vocab.CANDIDATE_STOPWORDS
) -> DataFrame:
    """The most frequent terms, numbered from 1; ties by term."""
    ranking = [F.desc("document_term_count"), F.asc("term")]
    top = term_frequencies(reviews, stopwords).orderBy(*ranking).limit(limit)
    # The window sees no more than `limit` rows.
    return top.select(
        F.row_number().over(Window.orderBy(*ranking)).alias("topic_candidate_id"),
        "term",
        "document_term_count",
        F.lit(vocab.CANDIDATE_METHOD).alias("topic_method"),
        F.lit("candidate_requires_review").alias("topic_status"),
    )
