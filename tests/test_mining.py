from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.functions.rows import join_with_hot_keys
from reviewloom.operators import mining

REVIEWS = "review_id string, rating double, sentiment_label string"
ASPECTS = "review_id string, aspect string"


@pytest.fixture
def data(spark):
    labels = ["Negative", "Negative", "Positive", "Positive", "Neutral", "Negative"]
    ratings = [1.0, 2.0, 5.0, 4.0, 3.0, 1.0]
    reviews = [(f"r{i}", r, s) for i, (r, s) in enumerate(zip(ratings, labels))]
    aspects = [("r0", "service"), ("r1", "service"), ("r2", "food"), ("r3", "food"), ("r5", "service"), ("r5", "food")]
    return spark.createDataFrame(reviews, REVIEWS), spark.createDataFrame(aspects, ASPECTS)


def brute_force(baskets, min_support, min_confidence, max_len):
    total, support = len(baskets), {}
    for size in range(1, max_len + 1):
        for basket in baskets:
            for chosen in combinations(sorted(basket), size):
                support[chosen] = support.get(chosen, 0) + 1
    support = {k: v / total for k, v in support.items() if v / total >= min_support}
    rules = {}
    for items, value in support.items():
        for size in range(1, len(items)):
            for right in combinations(items, size):
                left = tuple(i for i in items if i not in right)
                confidence = value / support[left]
                if confidence >= min_confidence:
                    rules[left, right] = (value, confidence, confidence / support[right])
    return support, rules


def test_transactions(data, rows):
    found = {r["review_id"]: r["items"] for r in rows(mining.transactions(*data))}
    assert len(found) == 6
    assert found["r0"] == ["aspect:service", "rating_low", "sentiment:Negative"]
    assert found["r4"] == ["rating_mid", "sentiment:Neutral"]


def test_transactions_of_copies_and_null_ids(spark, rows):
    reviews = spark.createDataFrame(
        [("x", 5.0, None), ("x", None, ""), (None, 2.5, "Neutral"), ("y", None, None)], REVIEWS
    )
    aspects = spark.createDataFrame([("x", "food"), ("x", "service"), (None, "food")], ASPECTS)
    found = sorted((r["review_id"] or "", r["items"]) for r in rows(mining.transactions(reviews, aspects)))
    assert found == [
        ("", ["aspect:food", "rating_high", "sentiment:Neutral"]),
        ("x", ["aspect:food", "aspect:service"]),
        ("x", ["aspect:food", "aspect:service", "rating_high"]),
    ]
    counted = sorted((r["items"], r["n"]) for r in rows(mining.baskets(reviews, aspects)))
    assert counted == sorted((items, 1) for _, items in found)


def test_rules_equal_brute_force(data, rows):
    baskets = [r["items"] for r in rows(mining.transactions(*data))]
    support, expected = brute_force(baskets, 0.1, 0.5, 3)
    sets = mining.frequent_itemsets(mining.baskets(*data), 0.1, 3)
    assert {tuple(r["itemset"]): r["support"] for r in rows(sets)} == pytest.approx(support)
    rules = rows(mining.mine_rules(*data, min_support=0.1, min_confidence=0.5))
    assert {(tuple(r["antecedent"]), tuple(r["consequent"])) for r in rules} == set(expected)
    for rule in rules:
        numbers = expected[tuple(rule["antecedent"]), tuple(rule["consequent"])]
        assert (rule["support"], rule["confidence"], rule["lift"]) == pytest.approx(numbers, abs=1e-6)
    top = rows(mining.top_rules(mining.mine_rules(*data, min_support=0.1, min_confidence=0.5), 1))
    assert top[0]["lift"] >= 1 and top[0]["lift"] == max(r["lift"] for r in rules)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sets(st.sampled_from("abcdef")), min_size=1, max_size=12), st.integers(1, 4))
def test_itemsets_of_any_length(spark, baskets, max_len):
    filled = [sorted(b) for b in baskets if b]
    df = spark.createDataFrame([(b, filled.count(b)) for b in filled], "items array<string>, n bigint").distinct()
    found = mining.frequent_itemsets(df, 0.2, max_len).collect()
    expected, _ = brute_force(filled, 0.2, 1.0, max_len) if filled else ({}, {})
    assert {tuple(r["itemset"]): r["support"] for r in found} == pytest.approx(expected)


def test_no_baskets_give_no_rules(spark, rows):
    empty = spark.createDataFrame([], REVIEWS), spark.createDataFrame([], ASPECTS)
    assert rows(mining.mine_rules(*empty)) == []


def test_join_with_hot_keys_is_an_inner_join(spark):
    left = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(6000)], "k string, v int")
    right = left.where("k <> 'k0'").groupBy("k").count()
    joined = join_with_hot_keys(left, right, "k", "count", 6000)
    assert joined.count() == left.join(right, "k").count() == 5999
    assert joined.exceptAll(left.join(right, "k")).count() == 0


def as_baskets(spark, baskets):
    return spark.createDataFrame([(sorted(b), n) for b, n in baskets], "items array<string>, n long")


def test_wide_baskets_level_by_level(spark, rows):
    import random

    rng = random.Random(6)
    common = [f"c{i:02}" for i in range(14)]
    plain = [sorted({*(c for c in common if rng.random() < 0.7), *(f"r{rng.randint(0, 40_000)}" for _ in range(200))}) for _ in range(60)]
    found = {tuple(r["itemset"]): (r["occurrences"], r["support"]) for r in rows(mining.frequent_itemsets(as_baskets(spark, [(b, 2) for b in plain]), 0.15, 5))}
    assert min(len(b) for b in plain) > 180
    kept = [[i for i in b if i.startswith("c")] for b in plain]
    support, _ = brute_force(kept, 0.15, 2, 5)
    assert {k: v[1] for k, v in found.items()} == pytest.approx(support)
    assert all(n == round(share * 120) for n, share in found.values()) and max(map(len, found)) == 5


@settings(max_examples=8, deadline=None)
@given(
    baskets=st.lists(st.sets(st.sampled_from("abcdefgh"), min_size=1), min_size=1, max_size=12),
    min_support=st.sampled_from([0.1, 0.3, 0.6]),
)
def test_levels_and_all_subsets_agree(spark, baskets, min_support):
    support, _ = brute_force(baskets, min_support, 2, 4)
    distinct = as_baskets(spark, [(b, 1) for b in baskets]).groupBy("items").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    limit = mining.SUBSETS
    try:
        for mining.SUBSETS in (0, 10_000):
            found = mining.frequent_itemsets(distinct, min_support, 4).collect()
            assert {tuple(r.itemset): r.support for r in found} == pytest.approx(support)
    finally:
        mining.SUBSETS = limit


def test_candidates_need_all_their_subsets(spark):
    frequent = spark.createDataFrame([(list(s),) for s in ("ab", "ac", "bc", "bd", "cd", "xy")], "itemset array<string>")
    found = {tuple(r.itemset): r.lasts for r in mining.candidate_sets(frequent, 2).collect()}
    assert found == {("a", "b"): ["c"], ("b", "c"): ["d"]}


def test_levels_write_counts_and_not_sets_of_baskets(spark, tmp_path, rows):
    """17 items in nearly all of 3,000 texts: 9,401 sets, 26 million pairs of a text and a set."""
    import random

    from reviewloom.session import ensure_checkpoint_dir

    rng = random.Random(3)
    common = [f"c{i:02}" for i in range(17)]
    plain = [[*(c for c in common if rng.random() < 0.98), f"r{i}"] for i in range(3_000)]
    ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    kept = spark.createDataFrame([(b[:-1], 1) for b in plain], "kept array<string>, n long").repartition(3)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        found = mining._level_wise(kept, F.lit(3_000), 0.45, 5)
        written = sum(p.stat().st_size for p in tmp_path.rglob("part-*"))
        counts = {tuple(r["itemset"]): r["occurrences"] for r in rows(found)}
    finally:
        spark.sparkContext.setCheckpointDir(before)
    assert len(counts) == mining.subsets_of(17, 5) and written < 4_000_000
    some = [("c00",), ("c01", "c05"), ("c02", "c03", "c16"), tuple(common[3:8])]
    assert [counts[s] for s in some] == [sum(set(s) <= set(b) for b in plain) for s in some]
