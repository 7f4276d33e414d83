"""Grouped views behind the dashboard: mood, aspects, words, topics, alerts."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.rows import unnest
from reviewloom.functions.scoring import dashboard_bucket
from reviewloom.functions.text import is_one_of, tokenize
from reviewloom.functions.values import mean_score, millionths, month_key


# -- scopes ------------------------------------------------------------------


def in_scope(
    df: DataFrame,
    branches: Sequence[str],
    first_month: str | None = None,
    last_month: str | None = None,
    month: str | None = None,
) -> DataFrame:
    """Rows of the chosen branches within an inclusive range of yyyy-MM months.

    ``month`` names a month column. Without it the range is put as bounds on
    ``review_date``, which reach the Parquet scan. A missing bound leaves that side open.
    No branches means no rows.
    """
    scoped = df.where(F.col("branch_id").isin(list(branches)) if branches else F.lit(False))
    if first_month:
        start = F.to_date(F.lit(f"{first_month}-01")).cast("timestamp")
        scoped = scoped.where(F.col(month) >= first_month if month else F.col("review_date") >= start)
    if last_month:
        end = F.add_months(F.to_date(F.lit(f"{last_month}-01")), 1).cast("timestamp")
        scoped = scoped.where(F.col(month) <= last_month if month else F.col("review_date") < end)
    return scoped


def negative_reviews(reviews: DataFrame) -> DataFrame:
    """Ratings up to 2."""
    return reviews.where(F.col("rating") <= 2)


def positive_reviews(reviews: DataFrame) -> DataFrame:
    """Ratings from 4."""
    return reviews.where(F.col("rating") >= 4)


def distinct_values(reviews: DataFrame, column: str) -> DataFrame:
    """Sorted non-null values for a filter box."""
    return reviews.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def distinct_months(reviews: DataFrame) -> DataFrame:
    """Sorted months that have reviews."""
    return distinct_values(reviews.select(month_key(F.col("review_date")).alias("month")), "month")


# -- ratings and mood --------------------------------------------------------


def scope_kpis(reviews: DataFrame) -> DataFrame:
    """Negative and positive reviews, negative share in percent, reviews in scope."""
    negative = F.count_if(F.col("rating") <= 2)
    return reviews.agg(
        negative.alias("negative_reviews"),
        F.count_if(F.col("rating") >= 4).alias("positive_reviews"),
        F.coalesce(F.try_divide(negative * 100.0, F.count("*")), F.lit(0.0)).alias("negative_ratio_pct"),
        F.count("*").alias("reviews_in_scope"),
    )


def rating_buckets(reviews: DataFrame) -> DataFrame:
    """Reviews per branch and rating group."""
    return (
        reviews.select("branch_id", dashboard_bucket(F.col("rating")).alias("rating_bucket"))
        .where(F.col("rating_bucket").isNotNull())
        .groupBy("branch_id", "rating_bucket")
        .agg(F.count("*").alias("count"))
    )


def sentiment_distribution(reviews_nlp: DataFrame) -> DataFrame:
    """Reviews per mood label."""
    return reviews_nlp.groupBy("sentiment_label").agg(F.count("*").alias("count"))


def sentiment_by_branch(reviews_nlp: DataFrame) -> DataFrame:
    """Mean sentiment score per branch."""
    return (
        reviews_nlp.where(F.col("branch_id").isNotNull())
        .groupBy("branch_id")
        .agg(mean_score(F.col("sentiment_score")).alias("sentiment_score"))
    )


def recent_negative_reviews(reviews: DataFrame, limit: int = 200) -> DataFrame:
    """The latest reviews with a rating up to 2."""
    return (
        negative_reviews(reviews)
        .orderBy(F.desc("review_date"), "review_id")
        .limit(limit)
    )


def review_examples(reviews: DataFrame, limit: int = 200) -> DataFrame:
    """The first reviews by id."""
    return reviews.orderBy("review_id").limit(limit)


# -- aspects -----------------------------------------------------------------


def aspect_sentiment(aspects: DataFrame) -> DataFrame:
    """Mentions and mean score per branch and aspect; a null score counts as 0."""
    score = F.coalesce("aspect_sentiment_score", F.lit(0.0))
    return aspects.groupBy("branch_id", "aspect").agg(
        F.count("*").alias("mention_count"), F.round(mean_score(score), 4).alias("average_sentiment_score")
    )


def aspect_volume(aspects: DataFrame) -> DataFrame:
    """Mentions and mean score per aspect, for all branches ("All") and for each one.

    The aspect rows shrink to one row per (branch, aspect) before the second grouping.
    """
    cells = aspects.groupBy("branch_id", "aspect").agg(
        F.count("aspect").alias("n"),
        F.count("aspect_sentiment_score").alias("scored"),
        F.sum(millionths(F.col("aspect_sentiment_score"))).alias("total"),
    )
    return (
        cells.groupingSets([["aspect"], ["branch_id", "aspect"]], "branch_id", "aspect")
        .agg(
            F.grouping("branch_id").alias("all_branches"),
            F.sum("n").alias("mention_count"),
            F.round(F.try_divide(F.sum("total"), F.sum("scored") * 1_000_000), 4).alias("average_sentiment_score"),
        )
        .select(
            F.when(F.col("all_branches") == 1, "All").otherwise(F.col("branch_id")).alias("branch_id"),
            "aspect",
            "mention_count",
            "average_sentiment_score",
        )
        .where(F.col("branch_id").isNotNull())
    )


def aspect_complaints(aspects: DataFrame) -> DataFrame:
    """Negative, positive and all mentions per aspect, most complaints first."""
    label = F.col("aspect_sentiment_label")
    return (
        aspects.groupBy("aspect")
        .agg(
            F.count_if(label == "Negative").alias("negative_mentions"),
            F.count_if(label == "Positive").alias("positive_mentions"),
            F.count(label).alias("total_mentions"),
        )
        .withColumn(
            "negative_share_pct",
            F.round(F.try_divide(F.col("negative_mentions") * 100.0, F.col("total_mentions")), 1),
        )
        .orderBy(F.desc("negative_mentions"), "aspect")
    )


def aspect_totals(aspects: DataFrame) -> DataFrame:
    """Mentions per aspect, most first."""
    return (
        aspects.groupBy("aspect")
        .agg(F.count("*").alias("mention_count"))
        .orderBy(F.desc("mention_count"), "aspect")
    )


# -- words -------------------------------------------------------------------


def word_frequencies(
    reviews: DataFrame, stopwords: Collection[str], limit: int = 80, text: str = "review_text"
) -> DataFrame:
    """The most frequent words of the given reviews, stop words left out."""
    words = F.filter(tokenize(F.col(text)), lambda t: ~is_one_of(t, stopwords))
    return (
        unnest(reviews, words, "word")
        .groupBy("word")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "word")
        .limit(limit)
    )


# -- topics ------------------------------------------------------------------


def topic_concentration(document_topics: DataFrame, reviews_nlp: DataFrame, topics: DataFrame) -> DataFrame:
    """How much more often a topic occurs in negative reviews than overall.

    The join is on review id. Both sides are counted per id first, so that copies of an
    id multiply as numbers, not as rows. Shares come from one row per topic.
    """
    assigned = document_topics.groupBy("review_id", "dominant_topic").agg(F.count("*").alias("copies"))
    labelled = reviews_nlp.groupBy("review_id").agg(
        F.count("*").alias("reviews"),
        F.count_if(F.col("sentiment_label") == "Negative").alias("negatives"),
    )
    per_topic = (
        assigned.join(labelled, "review_id")
        .groupBy(F.col("dominant_topic").alias("topic_id"))
        .agg(
            F.sum(F.col("copies") * F.col("reviews")).alias("n"),
            F.sum(F.col("copies") * F.col("negatives")).alias("n_negative"),
        )
    )
    # One row per topic, so the unpartitioned window is small by construction.
    everything = Window.partitionBy(F.lit(0))
    overall = F.col("n") / F.sum("n").over(everything)
    negative = F.coalesce(F.try_divide(F.col("n_negative"), F.sum("n_negative").over(everything)), F.lit(0.0))
    shares = per_topic.select("topic_id", overall.alias("overall"), negative.alias("negative"))
    themes = topics.select(
        "topic_id", F.initcap(F.array_join(F.slice("top_terms", 1, 5), ", ")).alias("theme")
    )
    return (
        shares.join(themes, "topic_id", "left")
        .select(
            "topic_id",
            "theme",
            F.round(F.try_divide(F.col("negative"), F.col("overall")), 2).alias("negative_lift"),
            F.round(F.col("negative") * 100, 1).alias("negative_share"),
            F.round(F.col("overall") * 100, 1).alias("overall_share"),
        )
        .orderBy(F.desc("negative_lift"), "topic_id")
    )


def numbered(df: DataFrame, order: Sequence[str], label: str, name: str) -> DataFrame:
    """Display numbers ("Group 1", "Theme 2") over a small summary table."""
    position = F.row_number().over(Window.orderBy(*order))
    return df.withColumn(name, F.concat(F.lit(f"{label} "), position.cast("string")))


def theme_titles(topics: DataFrame, words: int = 5) -> DataFrame:
    """Topics as "Theme n" with their first words."""
    shown = numbered(topics, ["topic_id"], "Theme", "theme_number")
    return shown.withColumn("title", F.initcap(F.array_join(F.slice("top_terms", 1, words), ", ")))


def group_titles(clusters: DataFrame, words: int = 6) -> DataFrame:
    """Clusters as "Group n" with their first words."""
    shown = numbered(clusters, ["cluster_id"], "Group", "customer_group")
    return shown.withColumn("common_words", F.array_join(F.slice("top_terms", 1, words), ", "))


# -- alerts ------------------------------------------------------------------


def alert_kpis(anomalies: DataFrame) -> DataFrame:
    """Flagged months and those of high severity."""
    return anomalies.agg(
        F.count_if("is_anomaly").alias("alert_count"),
        F.count_if(F.col("is_anomaly") & (F.col("alert_severity") == "high")).alias("high_alert_count"),
    )


def alerts_by_severity(anomalies: DataFrame) -> DataFrame:
    """Flagged months ordered by severity and month."""
    return anomalies.where("is_anomaly").orderBy("alert_severity", "month", "branch_id")
