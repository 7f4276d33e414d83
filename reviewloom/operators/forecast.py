"""Linear rating trend per branch: holdout check, forecast and risk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.values import clamp_rating, shift_month


@dataclass(frozen=True)
class TrendSettings:
    """Parameters of the forecast."""

    horizon: int = 3
    min_history: int = 6
    holdout: int = 2
    elevated_slope: float = -0.02
    watch_slope: float = -0.005
    band: float = 1.96


def branch_series(features: DataFrame) -> DataFrame:
    """Rated months per branch with their index ``x`` from 0 and the series length ``n``.

    The input has one row per branch and month, so a partition is one calendar at most.
    """
    by_branch = Window.partitionBy("branch_id")
    return features.where(F.col("average_rating").isNotNull()).select(
        "branch_id",
        "month",
        F.col("average_rating").alias("y"),
        (F.row_number().over(by_branch.orderBy("month")) - 1).alias("x"),
        F.count("*").over(by_branch).alias("n"),
    )


def skipped_branches(features: DataFrame, settings: TrendSettings = TrendSettings()) -> DataFrame:
    """Branches with too short a history."""
    return (
        features.where(F.col("average_rating").isNotNull())
        .groupBy("branch_id")
        .agg(F.count("*").alias("months_available"))
        .where(F.col("months_available") < settings.min_history)
    )


def _evaluation(settings: TrendSettings):
    held = F.col("held")
    size = F.size(held)

    def mean(term):
        return F.aggregate(F.transform(held, term), F.lit(0.0), lambda a, b: a + b) / size

    def miss(point):
        return F.abs(point["y"] - (F.col("train_intercept") + F.col("train_slope") * point["x"]))

    def naive(point):
        return F.abs(point["y"] - F.col("naive"))

    tiny = F.lit(2.220446049250313e-16)
    mae, naive_mae = mean(miss), mean(naive)
    metrics = F.struct(
        F.lit(settings.holdout).alias("holdout_size"),
        F.round(mae, 6).alias("mae"),
        F.round(F.sqrt(mean(lambda p: miss(p) * miss(p))), 6).alias("rmse"),
        F.round(mean(lambda p: miss(p) / F.greatest(F.abs(p["y"]), tiny)), 6).alias("mape"),
        F.round(naive_mae, 6).alias("naive_mae"),
        (mae < naive_mae).alias("beats_naive_baseline"),
    )
    return F.when((F.col("months_available") - settings.holdout >= 3) & (size > 0), metrics)


def forecast_ratings(features: DataFrame, settings: TrendSettings = TrendSettings()) -> DataFrame:
    """Trend, holdout metrics, risk level and forecast array per branch with enough history."""
    x, y = F.col("x"), F.col("y")
    training = x < F.col("n") - settings.holdout
    train_x, train_y = F.when(training, x), F.when(training, y)
    fitted = (
        branch_series(features)
        .where(F.col("n") >= settings.min_history)
        .groupBy("branch_id")
        .agg(
            F.count("*").alias("months_available"),
            F.max("month").alias("last_month"),
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.regr_syy(y, x).alias("syy"),
            F.regr_sxy(y, x).alias("sxy"),
            F.regr_slope(train_y, train_x).alias("train_slope"),
            F.regr_intercept(train_y, train_x).alias("train_intercept"),
            F.max_by(train_y, train_x).alias("naive"),
            # No more points than the holdout has.
            F.collect_list(F.when(~training, F.struct("x", "y"))).alias("held"),
        )
    )
    squared_error = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    spread = F.sqrt(squared_error / F.greatest(F.col("months_available") - 2, F.lit(1)))
    slope = F.col("slope")

    def step(ahead):
        value = F.col("intercept") + slope * (F.col("months_available") + ahead - 1)
        margin = F.col("spread") * settings.band
        return F.struct(
            ahead.alias("step_ahead"),
            shift_month(F.col("last_month"), ahead).alias("month"),
            F.round(clamp_rating(value), 4).alias("predicted_average_rating"),
            F.round(clamp_rating(value - margin), 4).alias("lower_bound"),
            F.round(clamp_rating(value + margin), 4).alias("upper_bound"),
        )

    risk = (
        F.when(slope <= settings.elevated_slope, "elevated")
        .when(slope <= settings.watch_slope, "watch")
        .otherwise("stable")
    )
    return fitted.withColumn("spread", spread).select(
        "branch_id",
        "months_available",
        F.round(slope, 6).alias("trend_slope_per_month"),
        risk.alias("risk_level"),
        _evaluation(settings).alias("evaluation"),
        F.transform(F.sequence(F.lit(1), F.lit(settings.horizon)), step).alias("forecast"),
    )


def forecast_rows(forecasts: DataFrame) -> DataFrame:
    """One row per branch and step."""
    return forecasts.select("branch_id", "risk_level", "trend_slope_per_month", F.inline("forecast"))


def observed_and_forecast(features: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Observed monthly ratings followed by the forecast, told apart by ``kind``."""
    observed = features.where(F.col("average_rating").isNotNull()).select(
        "branch_id",
        "month",
        F.lit("observed").alias("kind"),
        F.col("average_rating").alias("rating"),
        F.lit(None).cast("double").alias("lower_bound"),
        F.lit(None).cast("double").alias("upper_bound"),
    )
    ahead = forecast_rows(forecasts).select(
        "branch_id",
        "month",
        F.lit("forecast").alias("kind"),
        F.col("predicted_average_rating").alias("rating"),
        "lower_bound",
        "upper_bound",
    )
    return observed.unionByName(ahead)
