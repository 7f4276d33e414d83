import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.quantiles import exact_quantile
from reviewloom.operators import dashboard
from reviewloom.operators.quality import count_by
from reviewloom.operators.summaries import (
    branch_summary,
    dataset_summary,
    monthly_features,
    monthly_summary,
)

SCHEMA = (
    "review_id string, branch_id string, branch_name string, review_date timestamp, rating double, "
    "cleaned_text string, sentiment_label string, sentiment_score double"
)


def reviews(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def sample(spark):
    return reviews(
        spark,
        [
            ("r1", "a", "A", dt.datetime(2026, 1, 3), 5.0, "Great", "Positive", 0.5),
            ("r2", "a", "A two", dt.datetime(2026, 1, 9), 3.0, None, "Neutral", 0.0),
            ("r3", "b", "B", dt.datetime(2026, 3, 1), None, "Bad food", "Negative", -0.5),
            ("r4", None, None, None, 1.0, None, "Neutral", 0.0),
        ],
    )


def test_dataset_summary(sample, rows):
    (row,) = rows(dataset_summary(sample))
    assert row == {
        "record_count": 4,
        "branch_count": 2,
        "date_range_start": dt.datetime(2026, 1, 3),
        "date_range_end": dt.datetime(2026, 3, 1),
        "average_rating": 3.0,
        "rating_distribution": {"1.0": 1, "3.0": 1, "5.0": 1},
        "text_available_count": 2,
        "text_missing_count": 2,
        "average_text_length_chars": 6.5,
    }


def test_dataset_summary_of_nothing(spark, rows):
    (row,) = rows(dataset_summary(reviews(spark, [])))
    assert row["record_count"] == 0 and row["average_rating"] is None and row["rating_distribution"] == {}


def test_branch_summary(sample, rows):
    found = {r["branch_id"]: r for r in rows(branch_summary(sample))}
    assert set(found) == {"a", "b", "<missing>"}
    assert found["a"]["branch_name"] == "A" and found["a"]["average_rating"] == 4.0
    assert (found["a"]["text_available_count"], found["a"]["text_missing_count"]) == (1, 1)
    assert found["b"]["average_rating"] is None


def test_monthly_summary_has_every_month_of_every_branch(sample, rows):
    found = {(r["branch_id"], r["month"]): r for r in rows(monthly_summary(sample))}
    assert set(found) == {(b, m) for b in "ab" for m in ("2026-01", "2026-02", "2026-03")}
    assert found["a", "2026-01"]["review_count"] == 2 and found["a", "2026-01"]["is_observed"]
    empty = found["a", "2026-02"]
    assert empty["review_count"] == 0 and empty["average_rating"] is None
    assert empty["is_zero_volume"] and not empty["is_observed"] and empty["text_available_count"] == 0
    assert found["b", "2026-03"]["average_rating"] is None and found["b", "2026-03"]["is_observed"]


def test_monthly_summary_of_nothing(spark, rows):
    assert rows(monthly_summary(reviews(spark, []))) == []


def test_monthly_features_count_reviews_without_text(sample, rows):
    found = {(r["branch_id"], r["month"]): r for r in rows(monthly_features(sample))}
    assert found["a", "2026-01"]["average_sentiment_score"] == 0.25
    assert found["b", "2026-03"]["negative_ratio"] == 1.0
    assert found["b", "2026-01"]["negative_ratio"] is None


def test_count_by_marks_missing(sample, rows):
    counted = {r["branch_id"]: r["record_count"] for r in rows(count_by(sample, "branch_id"))}
    assert counted == {"a": 2, "b": 1, "<missing>": 1}


def test_rating_buckets(spark, rows):
    ratings = [0.0, 2.0, 2.5, 3.0, 3.5, 5.0, 6.0, None]
    df = spark.createDataFrame([("a", r) for r in ratings], "branch_id string, rating double")
    found = {r["rating_bucket"]: r["count"] for r in rows(dashboard.rating_buckets(df))}
    assert found == {"Negative (1-2)": 2, "Neutral (3)": 2, "Positive (4-5)": 2}


def test_scopes(sample, rows):
    assert dashboard.in_scope(sample, []).count() == 0
    assert dashboard.in_scope(sample, ["a", "b"], "2026-02", "2026-03").count() == 1
    for months in ((None, "2026-02"), ("2026-03", None)):
        both = dashboard.in_scope(sample, ["a", "b"], *months)
        first, last = months[0] or "0000-00", months[1] or "9999-12"
        shown = F.date_format("review_date", "yyyy-MM")
        expected = sample.where(F.col("branch_id").isin("a", "b") & shown.between(first, last))
        assert sorted(map(str, both.collect())) == sorted(map(str, expected.collect()))
    (kpis,) = rows(dashboard.scope_kpis(sample))
    assert (kpis["negative_reviews"], kpis["positive_reviews"], kpis["reviews_in_scope"]) == (1, 1, 4)
    assert kpis["negative_ratio_pct"] == 25.0
    (none,) = rows(dashboard.scope_kpis(sample.limit(0)))
    assert none["negative_ratio_pct"] == 0.0
    assert [r["month"] for r in rows(dashboard.distinct_months(sample))] == ["2026-01", "2026-03"]


def test_word_frequencies(spark, rows):
    df = spark.createDataFrame([("The food, the FOOD",), (None,), ("it's food",)], "review_text string")
    found = [(r["word"], r["count"]) for r in rows(dashboard.word_frequencies(df, ["the"], 2))]
    assert found == [("food", 3), ("it's", 1)]


def test_topic_concentration(spark, rows):
    assigned = spark.createDataFrame(
        [("r1", 0), ("r2", 0), ("r3", 1), ("r4", 1), ("zz", 1)], "review_id string, dominant_topic int"
    )
    labels = [("r1", "Negative"), ("r2", "Positive"), ("r3", "Negative"), ("r4", "Negative"), ("r5", "Negative")]
    nlp = spark.createDataFrame(labels, "review_id string, sentiment_label string")
    topics = spark.createDataFrame([(0, ["good", "food"]), (1, ["slow"])], "topic_id int, top_terms array<string>")
    found = rows(dashboard.topic_concentration(assigned, nlp, topics))
    assert [(r["topic_id"], r["theme"]) for r in found] == [(1, "Slow"), (0, "Good, Food")]
    assert [r["negative_lift"] for r in found] == [1.33, 0.67]
    assert [r["negative_share"] for r in found] == [66.7, 33.3]
    assert [r["overall_share"] for r in found] == [50.0, 50.0]


def test_aspect_views(spark, rows):
    data = [("a", "service", "Negative", -0.5), ("a", "service", "Positive", 0.25), ("b", "food", "Neutral", None)]
    df = spark.createDataFrame(
        data,
        "branch_id string, aspect string, aspect_sentiment_label string, aspect_sentiment_score double",
    )
    volume = {(r["branch_id"], r["aspect"]): r for r in rows(dashboard.aspect_volume(df))}
    assert set(volume) == {("All", "service"), ("All", "food"), ("a", "service"), ("b", "food")}
    assert volume["All", "service"]["average_sentiment_score"] == -0.125
    assert volume["b", "food"]["average_sentiment_score"] is None
    by_branch = {(r["branch_id"], r["aspect"]): r for r in rows(dashboard.aspect_sentiment(df))}
    assert by_branch["b", "food"]["average_sentiment_score"] == 0.0
    complaints = rows(dashboard.aspect_complaints(df))
    assert [r["aspect"] for r in complaints] == ["service", "food"]
    assert complaints[0]["negative_share_pct"] == 50.0


@pytest.mark.parametrize("share", [0.0, 0.1, 0.37, 0.5, 1.0])
def test_exact_quantile(spark, share):
    import numpy as np

    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=500), np.zeros(300), [1e12, -1e-12]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_quantile(df, "v", share) == pytest.approx(np.quantile(values, share), abs=1e-12)


def test_exact_quantile_with_values_that_are_not_finite(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, float("inf"), float("-inf"), float("nan"), None)], "v double")
    assert exact_quantile(df, "v", 0.5) == 2.0
    assert exact_quantile(df, "v", 0.0) == float("-inf") and exact_quantile(df, "v", 1.0) == float("inf")
    assert exact_quantile(df, "v", 0.6) == pytest.approx(2.4)


def test_exact_quantile_of_nothing(spark):
    with pytest.raises(ValueError):
        exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5)


def test_recent_negative_reviews(sample, rows):
    dated = sample.withColumn("rating", F.lit(2.0))
    found = [r["review_id"] for r in rows(dashboard.recent_negative_reviews(dated, 2))]
    assert found == ["r3", "r2"]


def test_month_range_reaches_the_scan(sample, spark, tmp_path):
    sample.write.parquet(str(tmp_path / "t"))
    scoped = dashboard.in_scope(spark.read.parquet(str(tmp_path / "t")), ["a"], "2026-01", "2026-02")
    assert scoped.count() == 2
    plan = scoped.select("review_date")._jdf.queryExecution().toString().split("PushedFilters")[-1]
    assert "GreaterThanOrEqual(review_da" in plan  # the plan text is cut off
