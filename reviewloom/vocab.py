"""Default vocabularies. Every operator takes them as parameters.

Fixed values: the word lists, labels, messages and thresholds here are data
that results depend on.
"""

from __future__ import annotations

POSITIVE_TERMS = frozenset(
    "amazing awesome best delicious excellent good great loved love nice perfect tasty wonderful".split()
)
NEGATIVE_TERMS = frozenset(
    "awful bad cold delay delayed disappointed disappointing horrible late poor rude slow terrible "
    "worst waste".split()
)

ASPECT_TERMS = {
    "food_quality": frozenset("food taste tasty flavor flavour delicious fresh cold hot".split()),
    "service": frozenset("service staff waiter waitress behavior behaviour rude slow".split()),
    "waiting_time": frozenset("wait waiting delay delayed late slow time".split()),
    "price_value": frozenset("price prices cost expensive cheap value worth".split()),
    "quantity": frozenset("quantity portion portions serving large small".split()),
    "hygiene": frozenset("clean cleanliness dirty hygiene smell washroom".split()),
    "ambience": frozenset("ambience atmosphere seating music parking place".split()),
}

CANDIDATE_STOPWORDS = frozenset(
    "a about after again all also and are at be been but by for from had has have here i in is it "
    "its me my of on or our that the their there this to too was we were with you your".split()
)

SENTIMENT_METHOD = "lexicon_baseline_v1"
ASPECT_METHOD = "keyword_baseline_v1"
CANDIDATE_METHOD = "frequency_baseline_v1"
TOPIC_METHOD = "tfidf_nmf_v1"
CLUSTER_METHOD = "tfidf_kmeans_v1"
ASSOCIATION_METHOD = "apriori_v1"
ANOMALY_METHOD = "isolation_forest_v1"
FORECAST_METHOD = "linear_trend_v1"
CRM_METHOD = "evidence_ranked_crm_v1"

# The keys are kept as they are even though most aspect names differ from them;
# an aspect without a key gets the templated action.
CRM_ACTIONS = {
    "service": "Review peak-hour staffing, greeting consistency, and table follow-up.",
    "food": "Review preparation consistency and sample recent negative food feedback.",
    "price": "Audit value perception, portion consistency, and menu communication.",
    "ambiance": "Inspect cleanliness, seating comfort, noise, and dining-area checks.",
    "wait_time": "Measure order-to-table time and add a peak-period escalation check.",
}
CRM_FALLBACK_ACTION = "Investigate recurring %s feedback and assign a branch owner."
CRM_OWNER = "Branch manager"
CRM_REVIEW_CYCLE = "Review weekly against rating and negative-ratio trend"

EXPERIENCE_LABELS = {
    "ambience": "Ambience",
    "food_quality": "Food Quality",
    "price_value": "Price and Value",
    "service": "Service",
    "wait_time": "Wait Time",
}

RULE_ITEM_LABELS = {
    "rating_low": "Low rating (1-2)",
    "rating_mid": "Neutral rating (3)",
    "rating_high": "High rating (4-5)",
}

DASHBOARD_BUCKETS = ("Negative (1-2)", "Neutral (3)", "Positive (4-5)")

COLUMN_LABELS = {
    "alert_reasons": "why it needs attention",
    "alert_severity": "urgency",
    "anomaly_score": "unusualness indicator",
    "aspect": "experience area",
    "average_rating": "average rating",
    "average_sentiment_score": "customer mood indicator",
    "branch_id": "branch",
    "branch_name": "branch",
    "cluster_id": "customer group",
    "confidence": "reliability",
    "consequent": "also mentioned",
    "dominant_topic": "main theme",
    "issue": "customer issue",
    "lift": "strength of pattern",
    "lower_bound": "lower expected range",
    "mention_count": "mentions",
    "month": "month",
    "negative_lift": "negative-review concentration",
    "negative_mentions": "negative mentions",
    "negative_ratio": "negative feedback share",
    "negative_share": "share within negative reviews",
    "negative_share_pct": "negative share %",
    "overall_share": "overall share",
    "positive_mentions": "positive mentions",
    "predicted_average_rating": "expected rating",
    "priority": "priority",
    "priority_score": "priority indicator",
    "rating": "rating",
    "recommended_action": "recommended action",
    "review_count": "reviews",
    "review_date": "review date",
    "review_id": "review reference",
    "review_text": "customer comment",
    "sentiment_label": "customer mood",
    "sentiment_score": "customer mood indicator",
    "size": "reviews in group",
    "support": "frequency",
    "top_terms": "common words",
    "total_mentions": "total mentions",
    "upper_bound": "upper expected range",
}

RECOMMENDATION_CUES = ("recommend", "action", "should we", "what to do", "improve", "fix")
COMPARISON_CUES = (
    "compare",
    "comparison",
    "across branches",
    "all branches",
    "branches",
    "each branch",
    "versus",
    " vs ",
)
MONTH_NAMES = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)
