"""Data-quality report and grouped counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.values import MISSING

LOWEST_RATING, HIGHEST_RATING = 1.0, 5.0


def count_by(reviews: DataFrame, column: str) -> DataFrame:
    """Rows per value; null counts under a marker."""
    return reviews.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(MISSING)).alias(column)).agg(
        F.count("*").alias("record_count")
    )


def count_map(counts: DataFrame, key: str, value: str = "record_count"):
    """A small grouped count as one map value (scalar subquery)."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value))))
    return counts.agg(F.map_from_entries(entries)).scalar()


def duplicate_ids(reviews: DataFrame) -> DataFrame:
    """Review ids that occur more than once, with their number of rows."""
    return (
        reviews.groupBy("review_id").agg(F.count("*").alias("occurrences")).where("occurrences > 1")
    )


def validate(reviews: DataFrame) -> DataFrame:
    """One-row report. Nothing is changed or dropped.

    The row metrics are one aggregate over narrow columns. The ids are the only part
    that shuffles with the data, after a map-side count; sample ids are the ten lowest.
    """
    rating, text = F.col("rating"), F.col("review_text")
    totals = reviews.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.coalesce(text, F.lit("")) == "").alias("missing_review_text"),
        F.count_if(rating.isNull()).alias("missing_rating"),
        F.count_if(F.col("review_date").isNull()).alias("missing_review_date"),
        F.count_if(~rating.between(LOWEST_RATING, HIGHEST_RATING)).alias("invalid_rating"),
        F.count_if("review_id_is_generated").alias("generated_review_ids"),
        F.min("review_date").alias("date_range_start"),
        F.max("review_date").alias("date_range_end"),
    )
    repeated = duplicate_ids(reviews)
    surplus = repeated.agg(F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0))).scalar()
    lowest = repeated.select(F.coalesce(F.col("review_id").cast("string"), F.lit("None")).alias("id"))
    samples = lowest.orderBy("id").limit(10).agg(F.array_sort(F.collect_list("id"))).scalar()
    report = totals.withColumns(
        {
            "duplicate_review_id_count": surplus,
            "duplicate_review_id_samples": samples,
            "records_by_branch": count_map(count_by(reviews, "branch_id"), "branch_id"),
        }
    )

    def message(count: str, text: str):
        return F.when(F.col(count) > 0, F.concat(F.col(count).cast("string"), F.lit(text)))

    return report.select(
        "total_records",
        "missing_review_text",
        "missing_rating",
        "missing_review_date",
        "invalid_rating",
        "duplicate_review_id_count",
        "duplicate_review_id_samples",
        "generated_review_ids",
        "records_by_branch",
        "date_range_start",
        "date_range_end",
        F.array_compact(
            F.array(
                message("missing_review_text", " records have missing review text."),
                F.when(F.col("total_records") == 0, F.lit("No records were provided for validation.")),
            )
        ).alias("warnings"),
        F.array_compact(
            F.array(
                message("invalid_rating", " records have ratings outside the valid range."),
                message("duplicate_review_id_count", " duplicate review IDs detected."),
            )
        ).alias("errors"),
    )
