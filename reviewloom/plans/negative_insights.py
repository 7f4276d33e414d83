"""Everything the negative-feedback page shows, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators import crm, dashboard


def negative_insights(
    tables: Mapping[str, DataFrame],
    branches: Sequence[str],
    first_month: str | None = None,
    last_month: str | None = None,
    stopwords: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """Views of the chosen branches and months over the stored result tables."""
    words = StopWordsRemover.loadDefaultStopWords("english") if stopwords is None else stopwords

    def scoped(name: str, month: str | None = None) -> DataFrame:
        return dashboard.in_scope(tables[name], branches, first_month, last_month, month)

    reviews = scoped("reviews_nlp")
    negative, positive = dashboard.negative_reviews(reviews), dashboard.positive_reviews(reviews)
    cases = tables["crm_cases"].where(F.col("branch_id").isin(list(branches)))
    return {
        "kpis": dashboard.scope_kpis(reviews),
        "rating_buckets": dashboard.rating_buckets(reviews),
        "negative_words": dashboard.word_frequencies(negative, words),
        "positive_words": dashboard.word_frequencies(positive, words),
        "complaint_trend": scoped("anomalies", "month").select("branch_id", "month", "negative_ratio"),
        "aspect_complaints": dashboard.aspect_complaints(scoped("review_aspects")),
        "topic_concentration": dashboard.topic_concentration(
            tables["document_topics"], reviews, tables["topics"]
        ),
        "cases": crm.cases_by_priority(cases),
        "recent_negative": dashboard.recent_negative_reviews(reviews).select(
            "branch_id", "review_date", "rating", "sentiment_label", "review_text"
        ),
    }
