"""Dates, months, numbers and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "<missing>"


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text to UTC; text without an offset is UTC, other text is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def month_start(moment: Column) -> Column:
    """First day of the month."""
    return F.trunc(moment, "month")


def month_key(moment: Column) -> Column:
    """Month label yyyy-MM."""
    return F.date_format(moment, "yyyy-MM")


def shift_month(month: Column, months: Column) -> Column:
    """The month label ``months`` later."""
    return F.date_format(F.add_months(F.to_date(month, "yyyy-MM"), months), "yyyy-MM")


def clamp_rating(value: Column) -> Column:
    """Limit to the rating scale 1..5."""
    return F.least(F.lit(5.0), F.greatest(F.lit(1.0), value))


def to_number(text: Column) -> Column:
    """Text to double; blanks, "nan" and other text are null."""
    return F.when(~F.lower(F.trim(text)).isin("", "nan"), F.trim(text)).try_cast("double")


def or_missing(key: Column) -> Column:
    """Group key in which null and empty become one marker."""
    return F.coalesce(F.nullif(key.cast("string"), F.lit("")), F.lit(MISSING))


def millionths(score: Column) -> Column:
    """A score with six decimals as a whole number."""
    return F.round(score * 1_000_000).cast("bigint")


def mean_score(score: Column) -> Column:
    """Average of scores that have six decimals.

    Summed as whole numbers, so the result does not depend on the order in which partial
    sums meet. No scores give null.
    """
    return F.try_divide(F.sum(millionths(score)), F.count(score) * 1_000_000)
