"""Dataset, branch and branch-month summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.values import millionths, month_key, month_start, or_missing


def dataset_summary(reviews: DataFrame) -> DataFrame:
    """One row over the whole dataset.

    The reviews are read and shuffled once, as counts per (branch, rating). Those few
    rows are then rolled up by branch and by rating, so that distinct branches and the
    histogram need no second scan.
    """
    text_length = F.length("cleaned_text")
    cells = reviews.groupBy(
        F.nullif(F.col("branch_id"), F.lit("")).alias("branch_id"), "rating"
    ).agg(
        F.count("*").alias("n"),
        F.count("cleaned_text").alias("texts"),
        F.sum(text_length).alias("text_chars"),
        F.min("review_date").alias("first_date"),
        F.max("review_date").alias("last_date"),
    )
    rolled = cells.groupingSets([["branch_id"], ["rating"]], "branch_id", "rating").agg(
        F.grouping("rating").alias("is_branch_row"),
        *(F.sum(c).alias(c) for c in ("n", "texts", "text_chars")),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    by_branch = F.col("is_branch_row") == 1
    rated = ~by_branch & F.col("rating").isNotNull()

    def total(column: str | Column, keep: Column) -> Column:
        return F.sum(F.when(keep, column if isinstance(column, Column) else F.col(column)))

    entries = F.collect_list(F.when(rated, F.struct(F.col("rating").cast("string"), F.col("n"))))
    return rolled.agg(
        F.coalesce(total("n", by_branch), F.lit(0)).alias("record_count"),
        F.count_if(by_branch & F.col("branch_id").isNotNull()).alias("branch_count"),
        F.min("first_date").alias("date_range_start"),
        F.max("last_date").alias("date_range_end"),
        F.round(F.try_divide(total(F.col("rating") * F.col("n"), rated), total("n", rated)), 4).alias(
            "average_rating"
        ),
        F.map_from_entries(F.array_sort(entries)).alias("rating_distribution"),
        F.coalesce(total("texts", by_branch), F.lit(0)).alias("text_available_count"),
        F.coalesce(total(F.col("n") - F.col("texts"), by_branch), F.lit(0)).alias("text_missing_count"),
        F.round(F.try_divide(total("text_chars", by_branch), total("texts", by_branch)), 2).alias(
            "average_text_length_chars"
        ),
    )


def _branch_name(first: str = "first_date") -> Column:
    """Of several names of a branch the one seen first, ties by name."""
    return F.min_by("branch_name", F.struct(first, "branch_name"))


def branch_summary(reviews: DataFrame) -> DataFrame:
    """Volume, rating and text coverage per branch.

    The first grouping has the name in its key and only numbers in its buffers, so it is
    a hash aggregate that combines map-side without sorting. The second one picks the
    name from the handful of rows left.
    """
    cells = reviews.groupBy(or_missing(F.col("branch_id")).alias("branch_id"), "branch_name").agg(
        F.min("review_date").alias("first_date"),
        F.count("*").alias("n"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rated"),
        F.count("cleaned_text").alias("texts"),
    )
    return cells.groupBy("branch_id").agg(
        _branch_name().alias("branch_name"),
        F.sum("n").alias("review_count"),
        F.round(F.try_divide(F.sum("rating_sum"), F.sum("rated")), 4).alias("average_rating"),
        F.sum("texts").alias("text_available_count"),
        (F.sum("n") - F.sum("texts")).alias("text_missing_count"),
    )


def on_complete_calendar(reviews: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Named sums per branch and month over every month from first to last.

    Reviews shuffle once, as partial sums per (branch, month, name): hash aggregation
    with numbers only, so a branch with a third of the rows is spread over its months
    and combined before it moves. A branch then holds at most one struct per calendar
    month, and the calendar is looked up in that array: no join. The bounds are a scalar
    subquery that reads the date column only. ``m`` is null for cells without reviews.
    """
    dated = reviews.where(F.col("review_date").isNotNull()).select(
        "*", or_missing(F.col("branch_id")).alias("_branch"), month_start(F.col("review_date")).alias("_month")
    )
    calendar = dated.agg(F.expr("sequence(min(_month), max(_month), interval 1 month)")).scalar()
    cells = dated.groupBy("_branch", "_month", "branch_name").agg(
        F.min("review_date").alias("first_date"),
        F.count("*").alias("n"),
        *(column.alias(name) for name, column in sums.items()),
    )
    months = cells.groupBy("_branch", "_month").agg(
        F.min(F.struct("first_date", "branch_name")).alias("_first"),
        F.struct(*(F.sum(name).alias(name) for name in ("n", *sums))).alias("m"),
    )
    per_branch = months.groupBy("_branch").agg(
        F.min("_first")["branch_name"].alias("branch_name"),
        F.map_from_entries(F.collect_list(F.struct("_month", "m"))).alias("_observed"),
    )
    return per_branch.select(
        F.col("_branch").alias("branch_id"), "branch_name", "_observed", F.explode(calendar).alias("_month")
    ).select(
        "branch_id",
        "branch_name",
        month_key(F.col("_month")).alias("month"),
        F.try_element_at("_observed", F.col("_month")).alias("m"),
    )


def _average(total: str, count: str, digits: int) -> Column:
    return F.round(F.try_divide(F.col(total), F.col(count)), digits)


_RATING = {"rating_sum": "sum(rating)", "rated": "count(rating)"}


def monthly_summary(reviews: DataFrame) -> DataFrame:
    """Reviews per branch and month, empty months included with null metrics."""
    wanted = _RATING | {"texts": "count(cleaned_text)"}
    grid = on_complete_calendar(reviews, {k: F.expr(v) for k, v in wanted.items()})
    return grid.select(
        "month",
        "branch_id",
        "branch_name",
        F.coalesce("m.n", F.lit(0)).alias("review_count"),
        _average("m.rating_sum", "m.rated", 4).alias("average_rating"),
        F.coalesce("m.texts", F.lit(0)).alias("text_available_count"),
        F.col("m").isNull().alias("is_zero_volume"),
        F.col("m").isNotNull().alias("is_observed"),
    )


def monthly_features(reviews_nlp: DataFrame) -> DataFrame:
    """Volume, rating and sentiment per branch and month; ratios are over all reviews."""
    score = F.col("sentiment_score")
    grid = on_complete_calendar(
        reviews_nlp,
        {k: F.expr(v) for k, v in _RATING.items()}
        | {
            "millionths": F.sum(millionths(score)),
            "scored": F.count(score),
            "negatives": F.count_if(F.col("sentiment_label") == "Negative"),
        },
    )
    mean = F.try_divide(F.col("m.millionths"), F.col("m.scored") * 1_000_000)
    return grid.select(
        "branch_id",
        "branch_name",
        "month",
        F.coalesce("m.n", F.lit(0)).alias("review_count"),
        _average("m.rating_sum", "m.rated", 4).alias("average_rating"),
        F.round(mean, 6).alias("average_sentiment_score"),
        _average("m.negatives", "m.n", 4).alias("negative_ratio"),
        F.col("m").isNull().alias("is_zero_volume"),
        F.col("m").isNotNull().alias("is_observed"),
    )
