"""Indexed search against a scan of all texts."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import lookups, search_index

KIND = "review_id string, branch_id string, cleaned_text string"


def reviews(spark, data):
    shown = {"branch_name": F.lit("n"), "rating": F.lit(1.0), "review_date": F.lit(None).cast("timestamp"), "review_text": F.col("cleaned_text")}
    return spark.createDataFrame(data, KIND).withColumns(shown)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(1)
    words = ["food", "Fool", "good", "späte", "Straße", "ΟΔΟΣ", "naïve", "漢字", "😀😁", "a", "oo", "%_"]
    rows = [(f"r{i:05}", "ab"[i % 2], " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(1_500)]
    return rows + [("x1", "a", None), ("x2", "a", ""), ("x3", "b", "oo"), (None, "b", "food for all"), ("r00001", "a", "food twice"), ("y", "b", "needle " + "hay" * 40_000)]


@pytest.fixture(scope="module")
def index(spark, data, tmp_path_factory):
    return search_index.build_search_index(reviews(spark, data).repartition(7), str(tmp_path_factory.mktemp("index")))


@pytest.mark.parametrize(
    ("query", "branch"),
    [("FOO", None), ("oo fo", "b"), ("späte Na", None), ("οδο", None), ("漢字 ", "a"), ("😀😁 😀", None), ("yhayh", None), ("oo", None), ("%_ %", None)],
)
def test_search_finds_what_a_scan_finds(spark, data, index, query, branch):
    for limit in (4_000,) if branch else (5, 4_000):
        found = search_index.search(index, query, branch, limit)
        expected = lookups.search_feedback(reviews(spark, data), query, branch, limit)
        key = lambda r: (r.review_id or "", r.branch_id, r.cleaned_text)
        ids = [r.review_id for r in found.collect()]
        assert ids == [r.review_id for r in expected.select("review_id").collect()]
        if limit == 4_000:
            assert sorted(map(key, found.collect())) == sorted(map(key, expected.collect()))


def test_small_steps_find_the_same(index, monkeypatch):
    whole = [r.review_id for r in search_index.search(index, "good food", limit=200).collect()]
    monkeypatch.setattr(search_index, "FIRST_STEP", 2)
    monkeypatch.setattr(search_index, "MOST_STEP", 64)
    assert [r.review_id for r in search_index.search(index, "good food", limit=200).collect()] == whole and len(whole) > 50


def test_a_search_opens_only_shelves_of_its_trigrams(index):
    plan = search_index.candidates(index, "food")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shelf" in plan and "In(gram" in plan
    lists = index.postings.where("gram = 'foo'").agg(F.max(F.size("places")), F.count("*")).first()
    assert lists[0] <= 1 << search_index.BLOCK_BITS


def test_index_of_no_texts(spark, tmp_path):
    index = search_index.build_search_index(reviews(spark, [("a", "b", None)]), str(tmp_path / "none"))
    assert search_index.search(index, "food").collect() == []
    again = search_index.open_search_index(spark, str(tmp_path / "none"))
    assert search_index.search(again, "fo").collect() == []


def test_lists_and_not_trigrams_travel(spark, monkeypatch):
    """600 texts of one line have 600 lists' worth of places, but a row for each trigram of a run only."""
    texts = spark.createDataFrame([(i // 400, i % 400, "späte 😀😁 " * 3 + "ab"[i % 2]) for i in range(600)], "block long, place int, text string").coalesce(1)
    lists = search_index._gram_lists(texts).collect()
    assert len({(r.gram, r.block) for r in lists}) == len(lists) == 2 * 11
    assert next(r.places for r in lists if (r.gram, r.block) == ("e 😀", 1)) == list(range(200))
    monkeypatch.setattr(search_index, "RUN_CHARACTERS", 100)
    cut = search_index._gram_lists(texts.select("block", "place", "text")).collect()
    join = lambda rows: sorted((r.gram, r.block, p) for r in rows for p in r.places)
    assert join(cut) == join(lists) and len(cut) > len(lists)


def test_texts_with_many_letters_are_taken_in_halves():
    texts = ["".join(map(chr, range(0x10000 + k, 0x10000 + 150_000, 1 + k % 3))) for k in range(5)] + ["", "ab", "aabaab"]
    lists = [r for b in search_index._run_lists(7, texts, search_index.np.arange(8) * 2) for r in b.to_pylist()]
    expected = {(t[i : i + 3], 2 * k) for k, t in enumerate(texts) for i in range(len(t) - 2)}
    assert {(r["gram"], p) for r in lists for p in r["places"]} == expected
    assert sum(len(r["places"]) for r in lists) == len(expected) and {r["block"] for r in lists} == {7}
