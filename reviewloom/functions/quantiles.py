"""Exact quantiles without gathering the values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def _order_statistic(values: DataFrame, rank: int, low: float, high: float) -> float:
    """Value at zero-based ``rank``; ``low`` and ``high`` are the extremes.

    Each pass counts the values in equal-width bins, goes on with the bin that holds the
    rank, and takes that bin's own extremes as the next range. Only BINS rows at most
    reach the driver, and a handful of passes separates any two doubles.
    """
    while low < high:
        position = F.floor((F.col("v") - low) / (high - low) * BINS)
        bins = (
            values.where(F.col("v").between(low, high))
            .groupBy(F.least(position, F.lit(BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        for row in sorted(bins, key=lambda r: r["bin"]):
            if rank < row["n"]:
                low, high = row["low"], row["high"]
                break
            rank -= row["n"]
    return low


def exact_quantile(df: DataFrame, column: str, share: float) -> float:
    """Linear interpolation between the two nearest order statistics of the values.

    Null and NaN are no values. Infinite ones count at the ends; bins span finite ones only.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    finite = F.abs("v") < math.inf
    count, below, above, low, high = values.agg(
        F.count("*"), F.count_if(F.col("v") == -math.inf), F.count_if(F.col("v") == math.inf),
        F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v"))),
    ).first()
    if not count:
        raise ValueError(f"no values in {column}")
    position = share * (count - 1)
    rank = math.floor(position)
    if rank < below:
        lower = -math.inf
    elif rank >= count - above:
        lower = math.inf
    else:
        lower = _order_statistic(values.where(finite), rank - below, low, high)
    if rank == position:
        return lower
    up_to, following = values.agg(
        F.count_if(F.col("v") <= lower), F.min(F.when(F.col("v") > lower, F.col("v")))
    ).first()
    upper = lower if up_to > rank + 1 else following
    if lower == upper or math.isinf(lower):
        return lower
    return lower + (upper - lower) * (position - rank)
