"""Derived text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import clean_text, word_count


def preprocess(reviews: DataFrame) -> DataFrame:
    """Add the cleaned text and its features; every row and column is kept."""
    cleaned = F.col("cleaned_text")
    return reviews.withColumn("cleaned_text", clean_text(F.col("review_text"))).withColumns(
        {
            "text_available": cleaned.isNotNull(),
            "text_length_chars": F.coalesce(F.length(cleaned), F.lit(0)),
            "text_word_count": word_count(cleaned),
            "preprocessing_status": F.when(cleaned.isNotNull(), "available").otherwise("missing_text"),
        }
    )
