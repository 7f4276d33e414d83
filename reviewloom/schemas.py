"""Typed schema of every table, used to read results back and for empty results."""

from __future__ import annotations

from pyspark.sql import types as T

_IDENTITY = "review_id string, brand_id string, branch_id string, branch_name string"

NORMALIZED_COLUMNS = [
    "review_id",
    "brand_id",
    "branch_id",
    "branch_name",
    "place_name_raw",
    "source",
    "review_date",
    "rating",
    "review_text",
    "language",
    "owner_response_text",
    "owner_response_date",
    "review_url",
    "reviewer_id",
    "reviewer_name",
    "raw_source_file",
    "review_id_is_generated",
]

# The columns that may leave the ingestion step: no reviewer, URL or owner response.
ANALYTICAL_COLUMNS = [
    "review_id",
    "brand_id",
    "branch_id",
    "branch_name",
    "source",
    "review_date",
    "rating",
    "review_text",
    "language",
    "raw_source_file",
    "review_id_is_generated",
    "cleaned_text",
    "text_available",
    "text_length_chars",
    "text_word_count",
    "preprocessing_status",
]

SENTIMENT_COLUMNS = [
    "sentiment_label",
    "sentiment_score",
    "sentiment_positive_hits",
    "sentiment_negative_hits",
    "sentiment_method",
    "sentiment_status",
    "aspect_count",
]

_PREPROCESSED = (
    f"{_IDENTITY}, source string, review_date timestamp, rating double, review_text string, "
    "language string, raw_source_file string, review_id_is_generated boolean, cleaned_text string, "
    "text_available boolean, text_length_chars int, text_word_count int, preprocessing_status string"
)
_MONTH_METRICS = (
    "review_count bigint, average_rating double, average_sentiment_score double, negative_ratio double, "
    "is_zero_volume boolean, is_observed boolean"
)

TABLES = {
    "reviews_normalized": (
        f"{_IDENTITY}, place_name_raw string, source string, review_date timestamp, rating double, "
        "review_text string, language string, owner_response_text string, owner_response_date timestamp, "
        "review_url string, reviewer_id string, reviewer_name string, raw_source_file string, "
        "review_id_is_generated boolean"
    ),
    "reviews_preprocessed": _PREPROCESSED,
    "reviews_nlp": (
        f"{_PREPROCESSED}, sentiment_label string, sentiment_score double, sentiment_positive_hits int, "
        "sentiment_negative_hits int, sentiment_method string, sentiment_status string, aspect_count int"
    ),
    "review_aspects": (
        "review_id string, branch_id string, review_date timestamp, aspect string, matched_terms string, "
        "aspect_sentiment_label string, aspect_sentiment_score double, aspect_method string, "
        "aspect_status string"
    ),
    "topic_candidates": (
        "topic_candidate_id int, term string, document_term_count bigint, topic_method string, "
        "topic_status string"
    ),
    "validation_report": (
        "total_records bigint, missing_review_text bigint, missing_rating bigint, "
        "missing_review_date bigint, invalid_rating bigint, duplicate_review_id_count bigint, "
        "duplicate_review_id_samples array<string>, generated_review_ids bigint, "
        "records_by_branch map<string,bigint>, date_range_start timestamp, date_range_end timestamp, "
        "warnings array<string>, errors array<string>"
    ),
    "dataset_summary": (
        "record_count bigint, branch_count bigint, date_range_start timestamp, date_range_end timestamp, "
        "average_rating double, rating_distribution map<string,bigint>, text_available_count bigint, "
        "text_missing_count bigint, average_text_length_chars double"
    ),
    "branch_summary": (
        "branch_id string, branch_name string, review_count bigint, average_rating double, "
        "text_available_count bigint, text_missing_count bigint"
    ),
    "monthly_summary": (
        "month string, branch_id string, branch_name string, review_count bigint, average_rating double, "
        "text_available_count bigint, is_zero_volume boolean, is_observed boolean"
    ),
    "monthly_features": f"branch_id string, branch_name string, month string, {_MONTH_METRICS}",
    "anomalies": (
        f"branch_id string, branch_name string, month string, {_MONTH_METRICS}, anomaly_score double, "
        "is_anomaly boolean, alert_reasons array<string>, alert_severity string"
    ),
    "association_rules": (
        "antecedent array<string>, consequent array<string>, support double, confidence double, lift double"
    ),
    "topics": "topic_id int, top_terms array<string>, top_term_weights array<double>",
    "document_topics": (
        "review_id string, branch_id string, review_date timestamp, dominant_topic int, "
        "dominant_topic_weight double"
    ),
    "clusters": "cluster_id int, size bigint, top_terms array<string>",
    "document_clusters": "review_id string, branch_id string, review_date timestamp, cluster_id int",
    "branch_forecasts": (
        "branch_id string, months_available bigint, trend_slope_per_month double, risk_level string, "
        "evaluation struct<holdout_size:int,mae:double,rmse:double,mape:double,naive_mae:double,"
        "beats_naive_baseline:boolean>, "
        "forecast array<struct<step_ahead:int,month:string,predicted_average_rating:double,"
        "lower_bound:double,upper_bound:double>>"
    ),
    "forecast_skipped": "branch_id string, months_available bigint",
    "crm_cases": (
        "case_id string, branch_id string, issue string, priority string, priority_score double, "
        "mention_count bigint, average_sentiment_score double, supporting_alert_count bigint, "
        "recommended_action string, suggested_owner string, status string, evidence_type string, "
        "review_cycle string"
    ),
    "stage_status": (
        "stage string, method string, status string, params map<string,string>, "
        "metrics map<string,double>"
    ),
    "manifest": (
        "manifest_version int, created_at_utc timestamp, data_status string, "
        "source_files array<struct<path:string,file_name:string,branch_id:string,branch_name:string,"
        "brand_id:string,size_bytes:bigint,sha256:string>>, "
        "normalized_output struct<path:string,record_count:bigint>, "
        "records_by_branch map<string,bigint>, records_by_source_file map<string,bigint>"
    ),
}


def table_schema(name: str) -> T.StructType:
    """Schema of a named table."""
    return T.StructType.fromDDL(TABLES[name])
