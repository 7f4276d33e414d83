"""Row generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """One row per non-null element of an array.

    The outer form with a null test behind it. For the plain form the optimizer puts a
    filter on the array below the projections, and computes an array that comes from
    text a second time just to find out whether it is empty.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


HOT_KEYS = 1000


def join_with_hot_keys(
    left: DataFrame, right: DataFrame, key: str, rows_per_key: str, total_rows: int
) -> DataFrame:
    """Inner join where ``right`` has one row per key and knows how many left rows it has.

    Keys with more than a thousandth of all left rows are broadcast, so their rows stay
    where they are. There can be at most a thousand such keys, so that side is small by
    construction. All other keys are joined by shuffle, or as adaptive execution decides.
    """
    is_hot = F.col(rows_per_key) > total_rows / HOT_KEYS
    hot, cold = F.broadcast(right.where(is_hot)), right.where(~is_hot)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(hot, key).unionByName(rest.join(cold, key))
