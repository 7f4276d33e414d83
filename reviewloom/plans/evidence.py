"""Evidence bundles per routed question, as nested columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.dashboard import aspect_sentiment
from reviewloom.operators.lookups import first_topics
from reviewloom.operators.mining import top_rules


def _rows(table: DataFrame) -> Column:
    """Struct of all columns but the branch."""
    return F.struct(*(F.col(c) for c in table.columns if c != "branch_id"))


def _list_per_branch(table: DataFrame, order: Column, name: str) -> DataFrame:
    # Result tables only: a branch has one row per month or per aspect here.
    ordered = F.struct(order.alias("_order"), _rows(table).alias("row"))
    return table.groupBy("branch_id").agg(
        F.transform(F.array_sort(F.collect_list(ordered)), lambda r: r["row"]).alias(name)
    )


def branch_evidence(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per branch with its summary, trend, aspects, alerts and forecast nested.

    Months are in order; aspects come by falling number of mentions, then by name.
    """
    summary = tables["branch_summary"]
    flagged = tables["anomalies"].where("is_anomaly")
    mentions = F.struct(-F.col("mention_count"), F.col("aspect"))
    base = summary.select("branch_id", F.struct(*summary.columns).alias("branch_summary"))
    parts = [
        _list_per_branch(tables["monthly_summary"], F.col("month"), "sentiment_trend"),
        _list_per_branch(aspect_sentiment(tables["review_aspects"]), mentions, "aspect_sentiment"),
        _list_per_branch(flagged, F.col("month"), "anomalies"),
        tables["branch_forecasts"].select("branch_id", _rows(tables["branch_forecasts"]).alias("forecast")),
    ]
    for part in parts:
        base = base.join(part, "branch_id", "left")
    return base


def brand_evidence(tables: Mapping[str, DataFrame], topics: int = 5, rules: int = 10) -> dict[str, Column]:
    """Brand-wide facts as scalar columns: the summary, first topics and strongest rules."""
    summary, best = tables["dataset_summary"], top_rules(tables["association_rules"], rules)
    first = first_topics(tables["topics"], topics)
    rule = F.struct(-F.col("lift"), *best.columns)
    return {
        "brand_summary": summary.select(F.struct(*summary.columns)).limit(1).scalar(),
        "top_topics": first.agg(F.array_sort(F.collect_list(F.struct(*first.columns)))).scalar(),
        "association_rules": best.agg(
            F.transform(
                F.array_sort(F.collect_list(rule)), lambda r: F.struct(*(r[c].alias(c) for c in best.columns))
            )
        ).scalar(),
    }


def brand_alerts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All flagged months of the brand: one table that every brand-wide question shares."""
    return tables["anomalies"].where("is_anomaly").orderBy("branch_id", "month")


def evidence(routed: DataFrame, tables: Mapping[str, DataFrame], key: str = "question_id") -> DataFrame:
    """Every routed question with the evidence of its scope.

    A comparison gets one struct per branch, a branch question its own row, a brand
    question the brand facts and the number of flagged months; ``brand_alerts`` lists these once for
    all such questions. A requested month that has no row is marked as not observed, and a
    branch without reviews has a bundle without a summary.
    """
    monthly = tables["monthly_summary"]
    month_row = F.struct(*(F.col(c) for c in monthly.columns if c not in ("branch_id", "month")))
    months = monthly.select("branch_id", F.col("month").alias("period"), month_row.alias("period_row"))
    asked = routed.select(key, "period", F.explode("branch_ids").alias("branch_id"))
    per_branch = (
        asked.join(months, ["branch_id", "period"], "left")
        .join(branch_evidence(tables), "branch_id", "left")
        .withColumn(
            "period_summary",
            F.when(
                F.col("period").isNotNull(),
                F.struct(
                    F.col("period").alias("month"),
                    F.coalesce("period_row.is_observed", F.lit(False)).alias("is_observed"),
                    F.col("period_row").alias("row"),
                ),
            ),
        )
    )
    bundle = F.struct(
        "branch_id",
        F.col("branch_summary.branch_name"),
        F.col("period_row").isNotNull().alias("observed"),
        "branch_summary",
        "period_summary",
        "sentiment_trend",
        "aspect_sentiment",
        "anomalies",
        "forecast",
    )
    listed = F.sort_array(F.collect_list(F.struct("branch_id", bundle.alias("bundle"))))
    collected = per_branch.groupBy(key).agg(F.transform(listed, lambda r: r["bundle"]).alias("branches"))
    none = F.array().cast(collected.schema["branches"].dataType)
    flagged = tables["anomalies"].where("is_anomaly").agg(F.count("*")).scalar()
    return (
        routed.join(collected, key, "left")
        .withColumn("branches", F.coalesce("branches", none))
        .withColumns(brand_evidence(tables))
        .withColumn("brand_alert_count", F.when(F.col("scope") == "brand", flagged))
    )


def scope_key(branch_ids: Column, period: Column) -> Column:
    """Digest of the branches asked about, in any order, and the month."""
    return F.sha2(F.to_json(F.struct(F.array_sort(branch_ids).alias("branch_ids"), period.alias("period"))), 256)


def shared_scopes(routed: DataFrame, key: str = "question_id") -> tuple[DataFrame, DataFrame]:
    """Questions that carry the key of what they ask about, and each such scope once.

    However many questions compare all branches, the list of branches is held once for a month:
    (question, scope, scope_key, ...) and (scope_key, scope, period, branch_ids).
    """
    keyed = routed.withColumn("scope_key", scope_key(F.col("branch_ids"), F.col("period")))
    scopes = keyed.select("scope_key", "scope", "period", "branch_ids").dropDuplicates(["scope_key"])
    return keyed.drop("branch_ids"), scopes


def scope_evidence(scopes: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The evidence of each scope, once; questions find theirs by ``scope_key``."""
    return evidence(scopes, tables, key="scope_key")
