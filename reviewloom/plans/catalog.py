"""Queries over the driver's tables, one or more per operator.

The default word lists hardly occur in the tables' invented prose, so the queries use
lists of words that do. Nested results are joined to text at the edge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import labels
from reviewloom.functions.quantiles import exact_quantile
from reviewloom.functions.text import tokenize
from reviewloom.functions.values import shift_month, to_number
from reviewloom.operators import (
    anomalies,
    clusters,
    crm,
    dashboard,
    features,
    forecast,
    lookups,
    mining,
    nlp,
    quality,
    routing,
    search_index,
    summaries,
    topics,
)
from reviewloom.operators.preprocess import preprocess
from reviewloom.plans.evidence import evidence, scope_evidence, shared_scopes
from reviewloom.session import ensure_checkpoint_dir, prepare
from reviewloom.sources import driver_tables as views
from reviewloom.sources import json_arrays, raw_json
from reviewloom.sources.manifest import file_digests

Query = Callable[[SparkSession, str], DataFrame]

PROBE_LEXICON = nlp.Lexicon(
    positive=("the", "und", "los", "les"),
    negative=("der", "de", "que", "was"),
    aspects={
        "service": ("that", "for", "with"),
        "food_quality": ("des", "die", "von"),
        "price_value": ("con", "una", "los"),
        "waiting_time": ("are", "from", "this"),
    },
)
PROBE_STOPWORDS = ("the", "that", "der", "que", "des", "les", "and")
RISK = forecast.TrendSettings(elevated_slope=-0.001, watch_slope=0.0)
BRANCHES = ("nation_1", "nation_3", "nation_7")
FIRST_MONTH, LAST_MONTH = "1996-03", "1998-10"

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    _QUERIES[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    """Every registered query."""
    return dict(_QUERIES)


# -- shared inputs -----------------------------------------------------------


def _reviews(spark, folder, level="nation"):
    return views.review_view(spark, folder, level)


def _ratings(spark, folder):
    """Reviews without their texts."""
    return views.review_view(spark, folder, texts=False)


def _clean(spark, folder, level="nation"):
    return preprocess(_reviews(spark, folder, level))


def _nlp(spark, folder, level="nation"):
    return nlp.build_nlp(_clean(spark, folder, level), PROBE_LEXICON)


def _scored(spark, folder, level="nation"):
    """Scored reviews and their aspects for queries that use both.

    The texts are cleaned and scored once; the result is checkpointed.
    """
    ensure_checkpoint_dir(spark)
    enriched = nlp.enrich(_clean(spark, folder, level), PROBE_LEXICON).drop("review_text")
    kept = enriched.checkpoint()
    return kept.drop("aspect_hits"), nlp.review_aspects(kept)


def _features(spark, folder, level="nation"):
    return summaries.monthly_features(_nlp(spark, folder, level)[0])


def _rule_alerts(features):
    """Rule-based alerts; any reason flags the month, two or more are high."""
    found = anomalies.rule_alerts(features)
    reasons = F.size("alert_reasons")
    return found.withColumn("is_anomaly", reasons > 0).withColumn(
        "alert_severity", F.when(reasons > 1, "high").otherwise(F.col("alert_severity"))
    )


def _flagged_by_count(features):
    """Eligible months where the number of reviews stands in for the model's flag and score."""
    months = anomalies.eligible_months(features)
    flag, score = F.col("review_count") % 3 == 0, -(F.col("review_count") % 5) / 8
    return anomalies.with_alerts(months.withColumns({"is_anomaly": flag, "anomaly_score": score}))


def _language_number():
    """A topic number per language."""
    return F.ascii("lang") * 256 + F.ascii(F.substring("lang", 2, 1))


def _date(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# -- raw records -------------------------------------------------------------


@query
def normalize_records(spark, folder):
    """Both record shapes, built from the review view, through the raw projection."""
    source = _reviews(spark, folder)
    number = F.col("review_id").cast("bigint")
    stamp = F.date_format("review_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    given_id = F.when(number % 7 != 0, F.col("review_id")).otherwise(F.lit(""))
    nested = F.struct(
        F.struct(F.col("branch_name").alias("name")).alias("place"),
        F.struct(F.col("review_id").alias("id"), F.lit("A").alias("name")).alias("author"),
        given_id.alias("reviewId"),
        stamp.alias("publishedAt"),
        F.col("rating"),
        F.col("review_text").alias("text"),
        F.col("language"),
    )
    flat = F.struct(
        given_id.alias("reviewId"),
        F.col("branch_name").alias("title"),
        F.when(number % 5 != 0, stamp).otherwise(F.lit("2 days ago")).alias("publishedAtDate"),
        F.col("rating").cast("string").alias("stars"),
        F.col("review_id").alias("reviewerId"),
        F.col("review_text").alias("text"),
        F.col("language"),
    )
    text = F.when(number % 2 == 0, F.to_json(nested)).otherwise(F.to_json(flat))
    records = source.select(
        F.parse_json(text).alias("raw"), "brand_id", "branch_id", "branch_name", "raw_source_file"
    )
    return raw_json.normalize(records).select(
        "review_id",
        "branch_id",
        "place_name_raw",
        _date("review_date"),
        "rating",
        "review_text",
        "language",
        "reviewer_id",
        "reviewer_name",
        "review_id_is_generated",
    )


@query
def array_exports(spark, folder):
    """Documents as records in JSON array files, read back by splits and ingested with all columns."""
    number = F.col("doc_id")
    answer = F.struct(
        F.concat(F.lit('Thanks, "we" {care}, \\o/ '), "source").alias("text"), F.lit("2026-08-11T00:00:00Z").alias("date")
    )
    record = F.struct(
        F.struct(F.upper("source").alias("name")).alias("place"),
        F.struct(number.cast("string").alias("id"), F.col("lang").alias("name")).alias("author"),
        number.cast("string").alias("reviewId"),
        F.concat(F.lit("https://example.org/"), number).alias("url"),
        F.col("text"),
        (number % 5 + 1).alias("rating"),
        F.when(number % 3 == 0, answer).alias("ownerResponse"),
        F.col("lang").alias("language"),
    )
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/exports-{uuid.uuid4().hex}"
    json_arrays.write_arrays(views.table(spark, folder, "documents").select(F.to_json(record).alias("value")), path)
    source = raw_json.ReviewSource(path, "web", "Web", "corpus")
    return raw_json.ingest(spark, [source]).drop("raw_source_file", "review_date").withColumn(
        "owner_response_date", _date("owner_response_date")
    )


@query
def source_file_digests(spark, folder):
    """Size and SHA-256 of the table files."""
    return file_digests(spark, f"{folder}/*.parquet").select("file_name", "size_bytes", "sha256")


@query
def count_by_source_file(spark, folder):
    return quality.count_by(_reviews(spark, folder), "raw_source_file")


@query
def validation_report(spark, folder):
    """The report over reviews with repeated ids and ratings outside the scale."""
    source = views.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("review_id"),
        F.col("l_returnflag").alias("branch_id"),
        F.when(F.col("l_quantity") > 3, F.col("l_quantity") / 8).alias("rating"),
        F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")).cast("timestamp").alias("review_date"),
        F.when(F.col("l_linenumber") == 1, "first").alias("review_text"),
        (F.col("l_linenumber") > 5).alias("review_id_is_generated"),
    )
    report = quality.validate(source)
    by_branch = F.transform(
        F.array_sort(F.map_entries("records_by_branch")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return report.select(
        "total_records",
        "missing_review_text",
        "missing_rating",
        "missing_review_date",
        "invalid_rating",
        "duplicate_review_id_count",
        F.array_join("duplicate_review_id_samples", ",").alias("duplicate_review_id_samples"),
        "generated_review_ids",
        F.array_join(by_branch, ",").alias("records_by_branch"),
        _date("date_range_start"),
        _date("date_range_end"),
        F.array_join("warnings", " ").alias("warnings"),
        F.array_join("errors", " ").alias("errors"),
    )


# -- text --------------------------------------------------------------------

_TEXT_COLUMNS = (
    "review_id",
    "cleaned_text",
    "text_available",
    "text_length_chars",
    "text_word_count",
    "preprocessing_status",
)


@query
def preprocess_reviews(spark, folder):
    return _clean(spark, folder).select(*_TEXT_COLUMNS)


@query
def preprocess_pages(spark, folder):
    """Tags and entities."""
    return preprocess(views.page_view(spark, folder)).select(*_TEXT_COLUMNS)


@query
def tokenize_documents(spark, folder):
    tokens = tokenize(F.col("cleaned_text"))
    return (
        preprocess(views.document_view(spark, folder))
        .select("review_id", tokens.alias("tokens"))
        .select(
            "review_id",
            F.size("tokens").alias("token_count"),
            F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
        )
    )


@query
def sentiment_reviews(spark, folder):
    return _nlp(spark, folder)[0].select(
        "review_id",
        "branch_id",
        "sentiment_label",
        "sentiment_score",
        "sentiment_positive_hits",
        "sentiment_negative_hits",
        "sentiment_method",
        "sentiment_status",
        "aspect_count",
    )


@query
def review_aspects(spark, folder):
    return _nlp(spark, folder)[1].select(
        "review_id",
        "branch_id",
        _date("review_date"),
        "aspect",
        "matched_terms",
        "aspect_sentiment_label",
        "aspect_sentiment_score",
        "aspect_method",
        "aspect_status",
    )


@query
def topic_candidates(spark, folder):
    return nlp.topic_candidates(preprocess(views.document_view(spark, folder)), 30, PROBE_STOPWORDS)


# -- summaries ---------------------------------------------------------------


@query
def dataset_summary(spark, folder):
    entries = F.transform(
        F.array_sort(F.map_entries("rating_distribution")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return summaries.dataset_summary(_clean(spark, folder)).select(
        "record_count",
        "branch_count",
        _date("date_range_start"),
        _date("date_range_end"),
        "average_rating",
        F.array_join(entries, ",").alias("rating_distribution"),
        "text_available_count",
        "text_missing_count",
        "average_text_length_chars",
    )


@query
def branch_summary(spark, folder):
    return summaries.branch_summary(_clean(spark, folder))


@query
def monthly_summary(spark, folder):
    return summaries.monthly_summary(_clean(spark, folder))


@query
def monthly_summary_by_region(spark, folder):
    return summaries.monthly_summary(_clean(spark, folder, "region"))


@query
def monthly_features(spark, folder):
    return _features(spark, folder)


# -- dashboard ---------------------------------------------------------------


@query
def distinct_branches(spark, folder):
    return dashboard.distinct_values(_ratings(spark, folder), "branch_id")


@query
def distinct_months(spark, folder):
    return dashboard.distinct_months(_ratings(spark, folder))


@query
def scope_kpis(spark, folder):
    scoped = dashboard.in_scope(_ratings(spark, folder), BRANCHES, FIRST_MONTH, LAST_MONTH)
    kpis = dashboard.scope_kpis(scoped)
    return kpis.withColumn("negative_ratio_pct", F.round("negative_ratio_pct", 4))


@query
def rating_buckets(spark, folder):
    return dashboard.rating_buckets(_ratings(spark, folder))


@query
def sentiment_distribution(spark, folder):
    return dashboard.sentiment_distribution(_nlp(spark, folder)[0])


@query
def sentiment_by_branch(spark, folder):
    scores = dashboard.sentiment_by_branch(_nlp(spark, folder)[0])
    return scores.withColumn("sentiment_score", F.round("sentiment_score", 6))


@query
def aspect_sentiment(spark, folder):
    return dashboard.aspect_sentiment(_nlp(spark, folder)[1])


@query
def aspect_volume(spark, folder):
    return dashboard.aspect_volume(_nlp(spark, folder)[1])


@query
def aspect_complaints(spark, folder):
    aspects = _nlp(spark, folder, "region")[1]
    scoped = dashboard.in_scope(aspects, ("africa", "asia", "middle_east"), FIRST_MONTH, LAST_MONTH)
    return dashboard.aspect_complaints(scoped)


@query
def aspect_totals(spark, folder):
    return dashboard.aspect_totals(_nlp(spark, folder)[1])


@query
def negative_word_frequencies(spark, folder):
    negative = dashboard.negative_reviews(_reviews(spark, folder))
    return dashboard.word_frequencies(negative, PROBE_STOPWORDS)


@query
def positive_word_frequencies(spark, folder):
    positive = dashboard.positive_reviews(_reviews(spark, folder))
    return dashboard.word_frequencies(positive, PROBE_STOPWORDS)


@query
def recent_negative_reviews(spark, folder):
    latest = dashboard.recent_negative_reviews(_ratings(spark, folder))
    return views.with_texts(latest, spark, folder).select(
        "review_id", "branch_id", _date("review_date"), "rating", "review_text"
    )


@query
def review_examples(spark, folder):
    return views.with_texts(dashboard.review_examples(_ratings(spark, folder)), spark, folder).select(
        "review_id", "branch_name", "rating", "review_text"
    )


@query
def topic_concentration(spark, folder):
    """Over-representation in negative reviews, with the language standing in for a topic."""
    reviews = _nlp(spark, folder)[0]
    languages = views.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), _language_number().alias("dominant_topic")
    )
    names = (
        views.table(spark, folder, "documents")
        .groupBy(_language_number().alias("topic_id"))
        .agg(F.array(F.lit("language"), F.max("lang")).alias("top_terms"))
    )
    return dashboard.topic_concentration(languages, reviews, names)


# -- baskets and rules -------------------------------------------------------


@query
def transactions(spark, folder):
    baskets = mining.transactions(*_scored(spark, folder))
    return baskets.select("review_id", F.array_join("items", "|").alias("items"))


@query
def distinct_baskets(spark, folder):
    return mining.baskets(*_scored(spark, folder)).select(F.array_join("items", "|").alias("items"), "n")


@query
def frequent_itemsets(spark, folder):
    found = mining.frequent_itemsets(mining.baskets(*_scored(spark, folder)))
    return found.select(
        F.array_join("itemset", "|").alias("itemset"),
        "occurrences",
        F.round("support", 6).alias("support"),
    )


@query
def word_itemsets(spark, folder):
    """Words that many documents have in common: wide baskets, sets of up to five words."""
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)))
    texts = views.table(spark, folder, "documents").select(words.alias("items")).where(F.size("items") > 0)
    found = mining.frequent_itemsets(texts.groupBy("items").agg(F.count("*").alias("n")), 0.45, 5)
    return found.select(
        F.array_join("itemset", "|").alias("itemset"), "occurrences", F.round("support", 6).alias("support")
    )


@query
def association_rules(spark, folder):
    rules = mining.mine_rules(*_scored(spark, folder))
    return rules.select(
        F.array_join("antecedent", "|").alias("antecedent"),
        F.array_join("consequent", "|").alias("consequent"),
        "support",
        "confidence",
        "lift",
    )


@query
def top_rules_labelled(spark, folder):
    rules = mining.top_rules(mining.mine_rules(*_scored(spark, folder)), 10)
    return rules.select(
        labels.rule_items_label(F.col("antecedent")).alias("when_mentioned"),
        labels.rule_items_label(F.col("consequent")).alias("also_mentioned"),
        "support",
        "confidence",
        "lift",
    )


# -- alerts, forecasts, cases ------------------------------------------------


@query
def rule_alerts(spark, folder):
    found = anomalies.rule_alerts(_features(spark, folder))
    return found.select(
        "branch_id",
        "month",
        "review_count",
        "average_rating",
        "negative_ratio",
        F.array_join("alert_reasons", ",").alias("alert_reasons"),
        "alert_severity",
    )


@query
def alert_kpis(spark, folder):
    return dashboard.alert_kpis(_rule_alerts(_features(spark, folder)))


@query
def alert_severities(spark, folder):
    """Reasons and severity with a flag besides the rules: all three severities occur."""
    found = _flagged_by_count(_features(spark, folder))
    reasons = F.array_join("alert_reasons", ",").alias("alert_reasons")
    return found.select("branch_id", "month", "is_anomaly", reasons, "alert_severity")


@query
def most_unusual_months(spark, folder):
    """The ten most unusual flagged months."""
    found = lookups.flagged_months(_flagged_by_count(_features(spark, folder)))
    return found.select("branch_id", "month", "anomaly_score", "review_count").limit(10)


@query
def theme_titles(spark, folder):
    """Numbers and titles of topics, with languages and their sources as topics and terms."""
    spoken = views.table(spark, folder, "documents").where(F.col("lang").isNotNull()).groupBy("lang")
    topics_table = spoken.agg(F.array_sort(F.collect_set("source")).alias("top_terms"))
    found = topics_table.select(_language_number().alias("topic_id"), "top_terms")
    return dashboard.theme_titles(found, 3).select("topic_id", "theme_number", "title")


@query
def alerts_by_severity(spark, folder):
    return dashboard.alerts_by_severity(_rule_alerts(_features(spark, folder))).select(
        "branch_id", "month", "alert_severity", "review_count"
    )


@query
def rating_quantile(spark, folder):
    """The exact quantile behind the anomaly flag, over monthly ratings."""
    rows = anomalies.eligible_months(_features(spark, folder)).checkpoint()  # read once for each pass
    value = exact_quantile(rows, "average_rating", 0.1)
    return rows.agg(F.count("*").alias("eligible_months")).withColumn("cut", F.round(F.lit(value), 6))


@query
def anomaly_scores(spark, folder):
    """Isolation forest over branch-months."""
    found = anomalies.detect_anomalies(_features(spark, folder))
    return found.withColumn("alert_reasons", F.array_join("alert_reasons", ","))


@query
def branch_forecasts(spark, folder):
    found = forecast.forecast_ratings(_features(spark, folder, "region"), RISK)
    return found.select(
        "branch_id",
        "months_available",
        "trend_slope_per_month",
        "risk_level",
        "evaluation.holdout_size",
        "evaluation.mae",
        "evaluation.rmse",
        "evaluation.mape",
        "evaluation.naive_mae",
        "evaluation.beats_naive_baseline",
    )


@query
def branch_forecast_months(spark, folder):
    return forecast.forecast_rows(forecast.forecast_ratings(_features(spark, folder), RISK))


@query
def forecast_skipped(spark, folder):
    """With a minimum history that part of the branches does not reach."""
    settings = forecast.TrendSettings(min_history=80)
    return forecast.skipped_branches(_features(spark, folder), settings)


@query
def observed_and_forecast(spark, folder):
    by_month = _features(spark, folder, "region")
    return forecast.observed_and_forecast(by_month, forecast.forecast_ratings(by_month, RISK))


@query
def crm_cases(spark, folder):
    reviews, aspects = _scored(spark, folder)
    cases = crm.build_cases(aspects, _rule_alerts(summaries.monthly_features(reviews)))
    return crm.ranked_cases(cases)


@query
def crm_cases_by_priority(spark, folder):
    """Cases without alerts, in display order with their position."""
    cases = crm.cases_by_priority(crm.build_cases(_nlp(spark, folder)[1], None, min_mentions=2))
    return labels.business_frame(
        cases, ["branch_id", "issue", "priority", "mention_count", "recommended_action"]
    )


@query
def top_issues_per_branch(spark, folder):
    cases = crm.build_cases(_nlp(spark, folder)[1], None)
    return crm.top_issues_per_branch(cases, 2).select("branch_id", "issue", "mention_count", "position")


# -- lookups -----------------------------------------------------------------


@query
def branch_trend(spark, folder):
    return lookups.of_branch(summaries.monthly_summary(_clean(spark, folder)), "nation_3")


@query
def search_feedback(spark, folder):
    found = lookups.search_feedback(_clean(spark, folder), "The ", limit=20)
    return found.select("review_id", "branch_id", "rating", _date("review_date"), "cleaned_text")


SEARCHES = ("The ", "eN unD ", "que la", "qu", "no such words")


@query
def search_indexed(spark, folder):
    """Several searches over one index of all reviews: frequent, rare, short and vain ones."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/search-{uuid.uuid4().hex}"
    index = search_index.build_search_index(_clean(spark, folder), path)
    found = None
    for words in SEARCHES:
        rows = search_index.search(index, words, limit=20).withColumn("query", F.lit(words))
        found = rows if found is None else found.unionByName(rows)
    return found.select("query", "review_id", "branch_id", "rating", _date("review_date"), "cleaned_text")


@query
def branch_performance(spark, folder):
    reviews = _clean(spark, folder)
    return lookups.branch_performance(
        summaries.monthly_summary(reviews),
        summaries.branch_summary(reviews),
        ["nation_3", "nation_1", "nowhere"],
        "1997-05",
    )


@query
def period_rows(spark, folder):
    """Every region for a month inside and a month outside the calendar."""
    monthly = summaries.monthly_summary(_clean(spark, folder, "region"))
    asked = monthly.select("branch_id").distinct().select(
        "branch_id", F.explode(F.array(F.lit("1997-05"), F.lit("2030-01"))).alias("month")
    )
    return lookups.period_rows(asked, monthly).select(
        "branch_id", "month", "is_observed", "review_count", "average_rating"
    )


@query
def business_labels(spark, folder):
    cases = dashboard.aspect_sentiment(_nlp(spark, folder)[1])
    named = cases.withColumn("branch_name", F.col("branch_id"))
    return labels.business_frame(
        named, ["branch_name", "branch_id", "aspect", "mention_count", "average_sentiment_score"]
    )


@query
def coerced_numbers(spark, folder):
    """Text to number over names and the JSON text of events, where most values are no numbers."""
    events = views.table(spark, folder, "events")
    return events.select(
        "event_id",
        to_number(F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(
            F.col("event_id").cast("string")
        )).alias("number"),
        shift_month(F.date_format("ts", "yyyy-MM"), (F.col("event_id") % 30).cast("int")).alias("month"),
    )


def _questions(spark, folder):
    """User turns, made to ask about branches, months and advice by their number."""
    turns = views.question_view(spark, folder)
    number = ((F.col("conv_id") + F.col("turn")) % 25).cast("string")
    kind = (F.col("conv_id") * 3 + F.col("turn")) % 8
    suffix = (
        F.when(kind == 0, F.concat(F.lit(" What should we improve at Nation_"), number, F.lit("?")))
        .when(kind == 1, F.concat(F.lit(" Nation "), number, F.lit(" in July 1997, no, in May  2000?")))
        .when(kind == 2, F.lit(" Compare them in 2001-3"))
        .when(kind == 3, F.lit(" trend 2000/11, 199705 or 200012"))
        .when(kind == 4, F.concat(F.lit(" NATION_"), number, F.lit(" against nation_3")))
        .otherwise(F.lit(""))
    )
    return turns.select("question_id", F.concat("question", suffix).alias("question"))


def _branch_list(spark, folder):
    nations = views.table(spark, folder, "nation")
    return nations.select(F.lower("n_name").alias("branch_id"), F.col("n_name").alias("branch_name"))


@query
def route_questions(spark, folder):
    routed = routing.route_questions(_questions(spark, folder), _branch_list(spark, folder))
    return routed.withColumn("branch_ids", F.array_join("branch_ids", ","))


def _evidence_inputs(spark, folder):
    """Routed questions and the result tables, stored as in a batch run."""
    reviews, aspects = _scored(spark, folder)
    by_month = summaries.monthly_features(reviews).checkpoint()
    tables = {
        "branch_summary": summaries.branch_summary(reviews),
        "monthly_summary": summaries.monthly_summary(reviews),
        "review_aspects": aspects,
        "anomalies": _rule_alerts(by_month),
        "branch_forecasts": forecast.forecast_ratings(by_month, RISK),
        "dataset_summary": summaries.dataset_summary(reviews),
        "topics": views.table(spark, folder, "documents").groupBy("lang").agg(
            F.count("*").alias("n")
        ).select(_language_number().alias("topic_id"), F.array("lang").alias("top_terms")),
        "association_rules": mining.mine_rules(reviews, aspects),
    }
    tables = {name: df.checkpoint() for name, df in tables.items()}
    routed = routing.route_questions(_questions(spark, folder), _branch_list(spark, folder)).checkpoint()
    return routed, tables


@query
def question_evidence(spark, folder):
    """Evidence per question, reduced to checkable columns."""
    found = evidence(*_evidence_inputs(spark, folder))
    observed = F.filter("branches", lambda b: b["observed"])
    return found.select(
        "question_id",
        "scope",
        "period",
        F.size("branches").alias("branch_count"),
        F.size(observed).alias("observed_count"),
        F.aggregate(
            "branches",
            F.lit(0).cast("bigint"),
            lambda total, b: total + F.coalesce(b["period_summary"]["row"]["review_count"], F.lit(0)),
        ).alias("period_reviews"),
        F.aggregate(
            "branches",
            F.lit(0).cast("bigint"),
            lambda total, b: total + F.coalesce(F.size(b["anomalies"]), F.lit(0)),
        ).alias("alert_months"),
        F.aggregate(
            "branches",
            F.lit(0).cast("bigint"),
            lambda total, b: total + F.coalesce(F.size(b["sentiment_trend"]), F.lit(0)),
        ).alias("trend_months"),
        F.col("brand_summary.record_count").alias("brand_reviews"),
        F.size("association_rules").alias("rule_count"),
        F.size("top_topics").alias("topic_count"),
        "brand_alert_count",
    )


@query
def question_scopes(spark, folder):
    """Questions with the number of those that share their scope."""
    routed = routing.route_questions(_questions(spark, folder), _branch_list(spark, folder))
    asked, scopes = shared_scopes(routed)
    sizes = asked.groupBy("scope_key").agg(F.count("*").alias("questions"))
    listed = scopes.select("scope_key", F.array_join("branch_ids", ",").alias("branch_ids"))
    found = asked.join(sizes, "scope_key").join(listed, "scope_key")
    return found.select("question_id", "scope", "period", "questions", "branch_ids")


def _scope_bundles(spark, folder):
    """One row per scope and branch with its bundle; comparisons also ask about a branch without reviews."""
    routed, tables = _evidence_inputs(spark, folder)
    more = F.array_append("branch_ids", F.lit("never_opened"))
    asked = routed.withColumn("branch_ids", F.when(F.col("scope") == "comparison", more).otherwise(F.col("branch_ids")))
    bundles = scope_evidence(shared_scopes(asked)[1], tables)
    return bundles.select("scope", "period", F.explode("branches").alias("b"))


@query
def scope_branches(spark, folder):
    """Contents of the evidence: summary, requested month, trend and alerts of each branch."""

    def listed(column, show):
        return F.coalesce(F.array_join(F.transform(column, show), ","), F.lit(""))

    return _scope_bundles(spark, folder).select(
        "scope",
        "period",
        "b.branch_id",
        "b.branch_name",
        "b.observed",
        F.col("b.branch_summary.review_count").alias("review_count"),
        F.col("b.period_summary.is_observed").alias("month_observed"),
        F.col("b.period_summary.row.review_count").alias("month_reviews"),
        listed("b.sentiment_trend", lambda m: F.concat_ws("=", m["month"], m["review_count"])).alias("trend"),
        listed("b.anomalies", lambda m: F.concat_ws("=", m["month"], m["alert_severity"])).alias("alerts"),
    )


@query
def scope_aspects(spark, folder):
    """Contents of the evidence: aspects of each branch in the order they are shown."""
    ranked = _scope_bundles(spark, folder).select(
        "scope", "period", "b.branch_id", F.posexplode("b.aspect_sentiment").alias("place", "a")
    )
    return ranked.select(
        "scope", "period", "branch_id", "place", "a.aspect", "a.mention_count", "a.average_sentiment_score"
    )


# -- term matrix and models --------------------------------------------------

TERMS = features.TermSettings(stopwords=("the", "and", "of", "der", "die", "la", "le"))


def _documents(spark, folder):
    """Cleaned documents, fixed like the stored table that models read in a batch run."""
    ensure_checkpoint_dir(spark)
    clean = preprocess(views.document_view(spark, folder))
    return clean.select("review_id", "branch_id", "review_date", "cleaned_text").checkpoint()


@query
def document_frequencies(spark, folder):
    """Vocabulary after frequency limits, with idf."""
    counts = features.term_counts(_documents(spark, folder), TERMS.stopwords)
    known = features.vocabulary(counts, counts.count(), TERMS)
    return known.withColumn("idf", F.round("idf", 6))


@query
def tfidf_weights(spark, folder):
    """The whole weighted matrix, words and word pairs."""
    matrix = features.build_matrix(_documents(spark, folder), TERMS, named=True)
    return features.weights(matrix).withColumn("weight", F.round("weight", 6))


@query
def topics_nmf(spark, folder):
    found = topics.fit_topics(_documents(spark, folder), topics.TopicSettings(terms=TERMS))
    return dashboard.theme_titles(found.topics).select(
        "topic_id",
        "theme_number",
        "title",
        F.array_join("top_terms", ",").alias("top_terms"),
        F.lit(found.reconstruction_error).alias("reconstruction_error"),
    )


@query
def document_topics(spark, folder):
    return topics.fit_topics(_documents(spark, folder), topics.TopicSettings(terms=TERMS)).document_topics


CLUSTERS = clusters.ClusterSettings(terms=TERMS)


@query
def clusters_kmeans(spark, folder):
    found = clusters.fit_clusters(_documents(spark, folder), CLUSTERS)
    return dashboard.group_titles(found.clusters).select(
        "cluster_id", "customer_group", "size", "common_words"
    )


@query
def document_clusters(spark, folder):
    return clusters.fit_clusters(_documents(spark, folder), CLUSTERS).document_clusters
