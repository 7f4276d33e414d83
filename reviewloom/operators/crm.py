"""Follow-up cases ranked by evidence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import vocab
from reviewloom.functions.values import mean_score, or_missing


def action_for(issue: Column, actions: Mapping[str, str], fallback: str) -> Column:
    """The action listed for an issue, or the template filled with its name."""
    templated = F.format_string(fallback, issue)
    if not actions:
        return templated
    pairs = [F.lit(part) for pair in actions.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), issue), templated)


def build_cases(
    aspects: DataFrame,
    alerts: DataFrame | None = None,
    min_mentions: int = 3,
    actions: Mapping[str, str] = vocab.CRM_ACTIONS,
    fallback: str = vocab.CRM_FALLBACK_ACTION,
) -> DataFrame:
    """One case per branch and aspect with enough mentions.

    Both sides of the join are aggregated first: (branch, aspect) cells and branches.
    """
    issue_name = F.coalesce(F.nullif(F.col("aspect"), F.lit("")), F.lit("unknown"))
    cells = (
        aspects.groupBy(or_missing(F.col("branch_id")).alias("branch_id"), issue_name.alias("issue"))
        .agg(
            F.count("*").alias("mention_count"),
            mean_score(F.coalesce("aspect_sentiment_score", F.lit(0.0))).alias("mean_score"),
        )
        .where(F.col("mention_count") >= min_mentions)
    )
    if alerts is None:
        with_alerts = cells.withColumns({"alerts": F.lit(0), "high_alerts": F.lit(0)})
    else:
        per_branch = (
            alerts.where("is_anomaly")
            .groupBy("branch_id")
            .agg(
                F.count("*").alias("alerts"),
                F.count_if(F.col("alert_severity") == "high").alias("high_alerts"),
            )
        )
        with_alerts = cells.join(per_branch, "branch_id", "left").fillna(0, ["alerts", "high_alerts"])
    complaint = F.greatest(F.lit(0.0), -F.col("mean_score"))
    score = F.col("mention_count") * complaint + F.col("alerts") * 2 + F.col("high_alerts") * 3
    return with_alerts.withColumn("score", score).select(
        F.concat_ws(":", "branch_id", "issue").alias("case_id"),
        "branch_id",
        "issue",
        F.when(F.col("score") >= 10, "high")
        .when(F.col("score") >= 4, "medium")
        .otherwise("low")
        .alias("priority"),
        F.round("score", 4).alias("priority_score"),
        "mention_count",
        F.round("mean_score", 4).alias("average_sentiment_score"),
        F.col("alerts").cast("bigint").alias("supporting_alert_count"),
        action_for(F.col("issue"), actions, fallback).alias("recommended_action"),
        F.lit(vocab.CRM_OWNER).alias("suggested_owner"),
        F.lit("open").alias("status"),
        F.lit("derived").alias("evidence_type"),
        F.lit(vocab.CRM_REVIEW_CYCLE).alias("review_cycle"),
    )


def ranked_cases(cases: DataFrame) -> DataFrame:
    """Highest score first."""
    return cases.orderBy(F.desc("priority_score"), "branch_id", "issue")


def cases_by_priority(cases: DataFrame) -> DataFrame:
    """High, medium, low, anything else; within a level the highest score first."""
    level = F.col("priority")
    rank = F.when(level == "high", 0).when(level == "medium", 1).when(level == "low", 2).otherwise(3)
    return cases.orderBy(rank, F.desc("priority_score"), "branch_id", "issue")


def top_issues_per_branch(cases: DataFrame, limit: int = 4) -> DataFrame:
    """The issues with most mentions of every branch."""
    order = Window.partitionBy("branch_id").orderBy(F.desc("mention_count"), "issue")
    return cases.withColumn("position", F.row_number().over(order)).where(F.col("position") <= limit)
