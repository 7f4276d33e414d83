import html
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.functions import text
from reviewloom.operators.nlp import build_nlp, term_frequencies, topic_candidates
from reviewloom.operators.preprocess import preprocess


def clean(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, review_text string")
    return [r[0] for r in preprocess(df).orderBy("i").select("cleaned_text").collect()]


def tokens(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(text.tokenize(F.col("t"))).collect()]


def test_cleaning(spark):
    values = ["  Great &amp; tasty <b>food</b>!  ", None, "   ", "a  b\x1cc", "ﬁne , ok", "<br>"]
    assert clean(spark, values) == ["Great & tasty food!", None, None, "a b c", "fine, ok", None]


def expected_clean(value):
    value = html.unescape(unicodedata.normalize("NFKC", value))
    value = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", value)).strip()
    return re.sub(r"\s+([,.;:!?])", r"\1", value) or None


ALPHABET = st.sampled_from("aZ é&<>;:!?, .\t\n\x0b\x1f\x85 　ﬁ½İßकु'_9" + "amp")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=1, max_size=20))
def test_cleaning_equals_the_python_steps(spark, values):
    assert clean(spark, values) == [expected_clean(v) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=1, max_size=20))
def test_tokens_equal_python_words(spark, values):
    assert tokens(spark, values) == [[w.lower() for w in re.findall(r"[\w']+", v)] for v in values]


def test_tokens_of_null(spark):
    assert tokens(spark, [None]) == [[]]


def test_text_features(spark, rows):
    df = spark.createDataFrame([("a b , c",), (None,)], "review_text string")
    first, second = rows(preprocess(df))
    assert (first["cleaned_text"], first["text_length_chars"], first["text_word_count"]) == ("a b, c", 6, 3)
    assert first["preprocessing_status"] == "available" and first["text_available"] is True
    assert (second["text_length_chars"], second["text_word_count"]) == (0, 0)
    assert second["preprocessing_status"] == "missing_text" and second["text_available"] is False


def reviews(spark, texts):
    data = [(f"r{i}", "b", t) for i, t in enumerate(texts, start=1)]
    df = spark.createDataFrame(data, "review_id string, branch_id string, cleaned_text string")
    return df.withColumn("review_date", F.lit(None).cast("timestamp"))


@pytest.mark.parametrize(
    "sentence, label, positive, negative",
    [
        ("Amazing delicious food and excellent service", "Positive", 3, 0),
        ("Terrible slow service and cold food", "Negative", 0, 3),
        (None, "Neutral", 0, 0),
        ("good " + "word " * 40, "Neutral", 1, 0),
        ("good bad", "Neutral", 1, 1),
    ],
)
def test_sentiment(spark, rows, sentence, label, positive, negative):
    (row,) = rows(build_nlp(reviews(spark, [sentence]))[0])
    assert row["sentiment_label"] == label
    assert (row["sentiment_positive_hits"], row["sentiment_negative_hits"]) == (positive, negative)
    words = len((sentence or "").split()) or 1
    assert row["sentiment_score"] == pytest.approx((positive - negative) / words, abs=1e-6)


def test_aspects(spark, rows):
    _, aspects = build_nlp(reviews(spark, ["The food was delicious but the service was slow"]))
    found = {r["aspect"]: r["matched_terms"] for r in rows(aspects)}
    assert found == {"food_quality": "delicious,food", "service": "service,slow", "waiting_time": "slow"}


def test_enrichment_keeps_every_review(spark, rows):
    enriched, aspects = build_nlp(reviews(spark, ["Great food", None]))
    by_id = {r["review_id"]: r for r in rows(enriched)}
    assert [by_id["r1"]["sentiment_label"], by_id["r2"]["sentiment_label"]] == ["Positive", "Neutral"]
    assert by_id["r1"]["aspect_count"] == 1 and by_id["r2"]["aspect_count"] == 0
    assert [r["review_id"] for r in rows(aspects)] == ["r1"]


def test_topic_candidates(spark, rows):
    df = reviews(spark, ["great food great service", "food was great"])
    found = rows(topic_candidates(df, 2))
    assert [(r["topic_candidate_id"], r["term"], r["document_term_count"]) for r in found] == [
        (1, "great", 3),
        (2, "food", 2),
    ]
    assert "was" not in {r["term"] for r in rows(term_frequencies(df))}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cc"]), max_size=8), min_size=1, max_size=6))
def test_term_counts_inside_a_row(spark, documents):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, w array<string>")
    grams = df.select("i", F.sort_array(text.with_bigrams(F.col("w"))).alias("g"))
    counted = grams.withColumn("s", text.run_starts(F.col("g"))).select(
        "i", text.run_lengths(F.col("g"), F.col("s")).alias("c")
    )
    for row in counted.collect():
        words = documents[row["i"]]
        every = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        assert {c["term"]: c["tf"] for c in row["c"]} == {t: every.count(t) for t in every}
