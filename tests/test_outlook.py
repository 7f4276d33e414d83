import datetime as dt

import numpy as np
import pytest

from reviewloom.operators import anomalies, crm, forecast
from reviewloom.operators.summaries import monthly_features
from reviewloom.schemas import table_schema

FEATURES = (
    "branch_id string, month string, review_count bigint, average_rating double, "
    "average_sentiment_score double, negative_ratio double"
)


def months(count, start=(2025, 1)):
    year, month = start
    return [f"{year + (month - 1 + i) // 12:04d}-{(month - 1 + i) % 12 + 1:02d}" for i in range(count)]


def features(spark, ratings, branch="a", count=10):
    data = [(branch, m, count, r, 0.1, 0.1) for m, r in zip(months(len(ratings)), ratings)]
    return spark.createDataFrame(data, FEATURES)


# -- forecasts ---------------------------------------------------------------


def test_falling_series_is_elevated(spark, rows):
    series = features(spark, [4.4 - 0.1 * i for i in range(8)])
    (row,) = rows(forecast.forecast_ratings(series, forecast.TrendSettings(horizon=2)))
    assert row["risk_level"] == "elevated" and row["trend_slope_per_month"] == pytest.approx(-0.1)
    assert row["evaluation"]["mae"] >= 0 and row["evaluation"]["beats_naive_baseline"] is True
    assert [f["month"] for f in row["forecast"]] == ["2025-09", "2025-10"]
    assert row["forecast"][0]["predicted_average_rating"] == pytest.approx(3.6)


def test_short_series_is_skipped(spark, rows):
    series = features(spark, [4.0])
    assert rows(forecast.forecast_ratings(series)) == []
    assert rows(forecast.skipped_branches(series)) == [{"branch_id": "a", "months_available": 1}]


def test_forecast_equals_least_squares(spark, rows):
    rng = np.random.default_rng(1)
    ratings = [None if i in (2, 5) else round(float(v), 4) for i, v in enumerate(rng.uniform(2, 5, 20))]
    (row,) = rows(forecast.forecast_ratings(features(spark, ratings)))
    y = np.array([r for r in ratings if r is not None])
    x = np.arange(len(y))
    slope, intercept = np.polyfit(x, y, 1)
    spread = np.sqrt(((y - intercept - slope * x) ** 2).sum() / (len(y) - 2))
    assert row["months_available"] == len(y)
    assert row["trend_slope_per_month"] == pytest.approx(slope, abs=1e-6)
    value = intercept + slope * (len(y) + 1)
    second = row["forecast"][1]
    assert second["predicted_average_rating"] == pytest.approx(value, abs=1e-4)
    assert second["lower_bound"] == pytest.approx(max(1, value - 1.96 * spread), abs=1e-4)
    assert second["upper_bound"] == pytest.approx(min(5, value + 1.96 * spread), abs=1e-4)
    slope, intercept = np.polyfit(x[:-2], y[:-2], 1)
    miss = np.abs(y[-2:] - intercept - slope * x[-2:])
    found = row["evaluation"]
    assert found["mae"] == pytest.approx(miss.mean(), abs=1e-6)
    assert found["rmse"] == pytest.approx(np.sqrt((miss**2).mean()), abs=1e-6)
    assert found["mape"] == pytest.approx((miss / y[-2:]).mean(), abs=1e-6)
    assert found["naive_mae"] == pytest.approx(np.abs(y[-2:] - y[-3]).mean(), abs=1e-6)
    # Labels go on from the last observed month.
    assert row["forecast"][0]["month"] == months(21)[20]


def test_forecast_is_clamped_and_stable(spark, rows):
    (row,) = rows(forecast.forecast_ratings(features(spark, [4.0, 4.2, 4.4, 4.6, 4.8, 5.0])))
    assert row["risk_level"] == "stable"
    assert all(f["predicted_average_rating"] == 5.0 for f in row["forecast"])


def test_observed_and_forecast(spark, rows):
    series = features(spark, [4.0] * 6)
    both = rows(forecast.observed_and_forecast(series, forecast.forecast_ratings(series)))
    assert [r["kind"] for r in sorted(both, key=lambda r: r["month"])] == ["observed"] * 6 + ["forecast"] * 3


# -- alerts ------------------------------------------------------------------


def alerts(spark, data):
    df = spark.createDataFrame(data, FEATURES + ", is_anomaly boolean")
    return {r["month"]: r for r in anomalies.with_alerts(df).collect()}


def test_alert_reasons_and_severity(spark):
    found = alerts(
        spark,
        [
            ("a", "2025-01", 10, 4.0, 0.1, 0.1, False),
            ("a", "2025-03", 20, 3.5, 0.1, 0.31, True),
            ("a", "2025-04", 10, 3.4, 0.1, 0.35, False),
            ("a", "2025-05", 12, 3.4, 0.1, 0.35, True),
            ("a", "2025-06", 12, 3.4, 0.1, 0.35, False),
        ],
    )
    assert found["2025-01"]["alert_reasons"] == [] and found["2025-01"]["alert_severity"] == "low"
    assert found["2025-03"]["alert_reasons"] == [
        "rating_drop_vs_previous_month",
        "negative_ratio_rise_vs_previous_month",
        "review_volume_shift_vs_previous_month",
        "model_outlier",
    ]
    assert found["2025-03"]["alert_severity"] == "high"
    assert found["2025-04"]["alert_reasons"] == ["review_volume_shift_vs_previous_month"]
    assert found["2025-04"]["alert_severity"] == "medium"
    assert found["2025-05"]["alert_severity"] == "medium" and found["2025-06"]["alert_severity"] == "low"


def collapsed_reviews(spark):
    data = []
    for i, month in enumerate(range(1, 11)):
        for j in range(5):
            score = 0.1 + 0.01 * (i % 3)
            data.append((f"{month}-{j}", dt.datetime(2025, month, 5), 4.0 + (j % 2), "Positive", score))
    for j in range(20):
        data.append((f"11-{j}", dt.datetime(2025, 11, 5), 1.0, "Negative", -0.5))
    return spark.createDataFrame(
        [(a, "b", "B", *rest) for a, *rest in data],
        "review_id string, branch_id string, branch_name string, review_date timestamp, rating double, "
        "sentiment_label string, sentiment_score double",
    )


def test_collapsed_month_is_flagged(spark, rows):
    monthly = monthly_features(collapsed_reviews(spark))
    by_month = {r["month"]: r for r in rows(monthly)}
    assert len(by_month) == 11
    assert (by_month["2025-11"]["review_count"], by_month["2025-11"]["average_rating"]) == (20, 1.0)
    found = rows(anomalies.detect_anomalies(monthly))
    assert found[0]["month"] == "2025-11" and found[0]["is_anomaly"] and found[0]["alert_severity"] == "high"
    assert sum(r["is_anomaly"] for r in found) <= 2
    assert set(found[0]) == set(table_schema("anomalies").fieldNames())
    assert rows(anomalies.detect_anomalies(monthly)) == found  # same seed, same result


def test_too_few_months_give_an_empty_table(spark):
    found = anomalies.detect_anomalies(features(spark, [4.0, 4.1]))
    assert found.count() == 0 and "anomaly_score" in found.columns


def test_forest_flags_the_contamination_share(spark):
    rng = np.random.default_rng(0)
    data = [
        (f"b{b}", m, int(n), float(r), float(s), float(q))
        for b in range(20)
        for m, n, r, s, q in zip(
            months(30), rng.integers(5, 60, 30), rng.normal(4, 0.3, 30), rng.normal(0, 0.1, 30), rng.uniform(0, 0.4, 30)
        )
    ]
    data.append(("far", "2025-01", 5000, 1.0, -1.0, 1.0))
    found = anomalies.model_scores(spark.createDataFrame(data, FEATURES)).collect()
    flagged = [r for r in found if r["is_anomaly"]]
    assert len(flagged) == pytest.approx(60, abs=2)
    assert min(found, key=lambda r: r["anomaly_score"])["branch_id"] == "far"


def test_small_months_are_not_scored(spark):
    assert anomalies.eligible_months(features(spark, [4.0] * 12, count=4)).count() == 0


# -- cases -------------------------------------------------------------------

ASPECTS = "branch_id string, aspect string, aspect_sentiment_score double"
ALERTS = "branch_id string, is_anomaly boolean, alert_severity string"


def test_case_priority(spark, rows):
    aspects = spark.createDataFrame([("branch_a", "service", -0.8)] * 8 + [(None, "food_quality", None)] * 3, ASPECTS)
    alert_rows = spark.createDataFrame([("branch_a", True, "high"), ("branch_a", False, "high")], ALERTS)
    first, second = rows(crm.ranked_cases(crm.build_cases(aspects, alert_rows)))
    assert first["case_id"] == "branch_a:service" and first["priority"] == "high"
    assert first["priority_score"] == pytest.approx(11.4) and first["status"] == "open"
    assert first["recommended_action"].startswith("Review peak-hour staffing")
    assert first["supporting_alert_count"] == 1
    assert second["branch_id"] == "<missing>" and second["priority"] == "low"
    assert second["recommended_action"] == "Investigate recurring food_quality feedback and assign a branch owner."
    assert set(first) == set(table_schema("crm_cases").fieldNames())


def test_too_few_mentions_make_no_case(spark):
    aspects = spark.createDataFrame([("a", "service", -1.0)], ASPECTS)
    assert crm.build_cases(aspects).count() == 0


def test_case_orders(spark, rows):
    data = [("a", "x", "low", 1.0, 9), ("a", "y", "high", 20.0, 3), ("b", "x", "medium", 30.0, 5), ("b", "z", "odd", 99.0, 5)]
    cases = spark.createDataFrame(
        data, "branch_id string, issue string, priority string, priority_score double, mention_count bigint"
    )
    assert [r["priority"] for r in rows(crm.cases_by_priority(cases))] == ["high", "medium", "low", "odd"]
    top = {(r["branch_id"], r["issue"]) for r in rows(crm.top_issues_per_branch(cases, 1))}
    assert top == {("a", "x"), ("b", "x")}
