"""Point lookups over the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import snippet

#: Columns that a search shows.
SEARCH_COLUMNS = ("review_id", "branch_id", "branch_name", "rating", "review_date", "cleaned_text", "review_text")


def of_branch(table: DataFrame, branch_id: str) -> DataFrame:
    """Rows of one branch; an unknown branch has none."""
    return table.where(F.col("branch_id") == branch_id)


def branch_cases(ranked: DataFrame, branch_id: str | None = None, limit: int = 10) -> DataFrame:
    """The first follow-up cases by rank, optionally of one branch."""
    chosen = ranked if branch_id is None else of_branch(ranked, branch_id)
    return chosen.orderBy(F.desc("priority_score"), "branch_id", "issue").limit(limit)


def flagged_months(anomalies: DataFrame, branch_id: str | None = None) -> DataFrame:
    """Months flagged by the model, most unusual first."""
    flagged = anomalies.where("is_anomaly")
    chosen = flagged if branch_id is None else of_branch(flagged, branch_id)
    return chosen.orderBy("anomaly_score", "branch_id", "month")


def first_topics(topics: DataFrame, limit: int = 5) -> DataFrame:
    """The first topics by number."""
    return topics.orderBy("topic_id").limit(limit)


def search_feedback(
    reviews: DataFrame, query: str, branch_id: str | None = None, limit: int = 10
) -> DataFrame:
    """Reviews whose cleaned text contains the query, any case; the lowest ids first.

    Looks into all texts; ``search_index`` answers repeated searches from an index.
    """
    hits = reviews.where(F.contains(F.lower("cleaned_text"), F.lit(query.lower())))
    chosen = hits if branch_id is None else of_branch(hits, branch_id)
    shown = {"cleaned_text": snippet(F.col("cleaned_text"))}
    return chosen.orderBy("review_id").limit(limit).select(*(shown.get(c, F.col(c)).alias(c) for c in SEARCH_COLUMNS))


def branch_performance(
    monthly: DataFrame, branches: DataFrame, branch_ids: Sequence[str], period: str | None = None
) -> DataFrame:
    """One row per requested branch; ``observed`` tells whether the month has a row.

    Without a period nothing is observed: lifetime numbers never stand in for a month.
    """
    spark = monthly.sparkSession
    wanted = spark.createDataFrame([(b,) for b in branch_ids], "branch_id string")
    names = branches.where(F.col("branch_id").isin(list(branch_ids))).select("branch_id", "branch_name")
    month = monthly.where(
        F.col("branch_id").isin(list(branch_ids)) & (F.col("month") == F.lit(period))
    ).select(
        "branch_id",
        F.lit(True).alias("observed"),
        "is_observed",
        "review_count",
        "average_rating",
        "text_available_count",
    )
    return (
        wanted.join(names, "branch_id", "left")
        .join(month, "branch_id", "left")
        .select(
            "branch_id",
            "branch_name",
            F.lit(period).cast("string").alias("period"),
            F.coalesce("observed", F.lit(False)).alias("observed"),
            F.coalesce("is_observed", F.lit(False)).alias("is_observed"),
            "review_count",
            "average_rating",
            "text_available_count",
        )
    )


def period_rows(requests: DataFrame, monthly: DataFrame) -> DataFrame:
    """Monthly row of each requested (branch, month), or a row marked as not observed."""
    return requests.join(monthly, ["branch_id", "month"], "left").withColumn(
        "is_observed", F.coalesce("is_observed", F.lit(False))
    )
