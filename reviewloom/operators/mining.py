"""Baskets, frequent item sets and association rules."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.scoring import mining_bucket
from reviewloom.session import ensure_checkpoint_dir

#: Sets of a basket that are counted without pruning between lengths.
SUBSETS = 500
#: Baskets of one block, a bit each in the rows of its items; candidates of one step over a block, on average.
BLOCK_BASKETS, STEP_CANDIDATES = 4096, 4096


def _aspect_items(aspects: DataFrame) -> DataFrame:
    # A set per review id is bounded by the number of aspects and combined map-side.
    return aspects.groupBy(F.col("review_id").alias("_aspect_id")).agg(
        F.collect_set(F.concat(F.lit("aspect:"), F.col("aspect"))).alias("_aspects")
    )


def _items():
    sentiment = F.nullif(F.col("sentiment_label"), F.lit(""))
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.coalesce(F.col("_aspects"), F.array().cast("array<string>")),
                F.array_compact(
                    F.array(F.concat(F.lit("sentiment:"), sentiment), F.col("_bucket"))
                ),
            )
        )
    )


def transactions(reviews_nlp: DataFrame, aspects: DataFrame) -> DataFrame:
    """One sorted item array per review; reviews without any item are left out.

    A null review id matches a null one. The aspect side has one row per id, so a hot id
    is skewed on the review side only, which adaptive execution splits.
    """
    sets = _aspect_items(aspects)
    left = reviews_nlp.withColumn("_bucket", mining_bucket(F.col("rating")))
    joined = left.join(sets, F.col("review_id").eqNullSafe(F.col("_aspect_id")), "left")
    return joined.select("review_id", _items().alias("items")).where(F.size("items") > 0)


def baskets(reviews_nlp: DataFrame, aspects: DataFrame) -> DataFrame:
    """Distinct item arrays with their number of reviews.

    Reviews are counted per (id, label, bucket) before the join. That leaves at most a
    handful of rows per id, however many copies an id has, so the join cannot be skewed.
    """
    counted = reviews_nlp.groupBy(
        "review_id", "sentiment_label", mining_bucket(F.col("rating")).alias("_bucket")
    ).agg(F.count("*").alias("n"))
    sets = _aspect_items(aspects)
    joined = counted.join(sets, F.col("review_id").eqNullSafe(F.col("_aspect_id")), "left")
    return (
        joined.select(_items().alias("items"), "n")
        .where(F.size("items") > 0)
        .groupBy("items")
        .agg(F.sum("n").alias("n"))
    )


def _pruned(distinct_baskets: DataFrame, total: Column, min_support: float) -> DataFrame:
    """Baskets with their frequent items only, equal ones as one: (kept, n).

    Items leave their basket with its number, never with the basket itself.
    """
    items = distinct_baskets.select("basket", "n", F.explode("items").alias("item"))
    single = items.groupBy("item").agg(F.sum("n").alias("occurrences")).where(F.col("occurrences") / total >= min_support)
    return (
        items.join(single, "item", "left_semi")
        .groupBy("basket", "n")
        .agg(F.array_sort(F.collect_list("item")).alias("kept"))
        .groupBy("kept")
        .agg(F.sum("n").alias("n"))
    )


def _all_subsets(pruned: DataFrame, max_len: int) -> DataFrame:
    """Every set of up to ``max_len`` items of every basket: (itemset, n)."""
    level = pruned.select(
        "kept", "n", F.posexplode("kept").alias("last", "item")
    ).select("kept", "n", "last", F.array("item").alias("itemset"))
    levels = level.select("itemset", "n")
    for _ in range(1, max_len):
        rest = F.slice("kept", F.col("last") + 2, F.size("kept"))
        level = level.select(
            "kept", "n", "last", "itemset", F.posexplode(rest).alias("step", "item")
        ).select(
            "kept",
            "n",
            (F.col("last") + F.col("step") + 1).alias("last"),
            F.array_append("itemset", F.col("item")).alias("itemset"),
        )
        levels = levels.unionByName(level.select("itemset", "n"))
    return levels


def candidate_sets(frequent: DataFrame, size: int) -> DataFrame:
    """(itemset, lasts): the items that may follow each frequent set of ``size`` items, by the level itself.

    Two sets that differ in their last item only make a candidate, and it stays if all its other
    subsets are frequent too.
    """
    named = frequent.select("itemset", F.slice("itemset", 1, size - 1).alias("stem"), F.element_at("itemset", -1).alias("last"))
    other = named.select("stem", F.col("last").alias("next"))
    made = named.join(other, "stem").where("last < next").select("itemset", "next")
    if size > 1:
        # Without its last two items a subset lacks one of the first ``size - 1``.
        grown = F.array_append("itemset", F.col("next"))
        lacking = F.transform(F.sequence(F.lit(0), F.lit(size - 2)), lambda i: F.filter(grown, lambda _, k: k != i))
        parts = made.select("itemset", "next", F.explode(lacking).alias("part"))
        known = parts.join(frequent.select(F.col("itemset").alias("part")), "part", "left_semi")
        made = known.groupBy("itemset", "next").count().where(F.col("count") == size - 1)
    return made.groupBy("itemset").agg(F.collect_list("next").alias("lasts"))


def _block(kept: list[list[str]], counts: list[int]) -> pa.RecordBatch:
    """Baskets as bits: one row of bits for each item, and one for each binary digit of their numbers of reviews."""
    names = sorted({item for basket in kept for item in basket})
    place = {item: i for i, item in enumerate(names)}
    held = np.zeros((len(names), len(kept)), bool)
    for column, basket in enumerate(kept):
        held[[place[item] for item in basket], column] = True
    numbers = np.array(counts, np.int64)
    digits = numbers >> np.arange(int(numbers.max()).bit_length())[:, None] & 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([names], pa.list_(pa.string())),
            pa.array([np.packbits(held, axis=1).tobytes()], pa.binary()),
            pa.array([np.packbits(digits.astype(bool), axis=1).tobytes()], pa.binary()),
            pa.array([len(kept)], pa.int32()),
        ],
        ["names", "held", "digits", "baskets"],
    )


def _blocks(pruned: DataFrame) -> DataFrame:
    """Baskets in blocks of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_BASKETS):
                part = batch.slice(first, BLOCK_BASKETS)
                yield _block(part["kept"].to_pylist(), part["n"].to_pylist())

    return pruned.select("kept", "n").mapInArrow(run, "names array<string>, held binary, digits binary, baskets int")


def _occurrences(blocks: DataFrame, grown: DataFrame) -> DataFrame:
    """(itemset, occurrences) of the sets that ``grown`` makes: (itemset, lasts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                place, width = {item: i for i, item in enumerate(one["names"])}, -(-one["baskets"] // 8)
                held = np.frombuffer(one["held"], np.uint8).reshape(-1, width)
                digits = np.frombuffer(one["digits"], np.uint8).reshape(-1, width)
                itemsets, occurrences = [], []
                for candidate in one["step"]:
                    lasts = [item for item in candidate["lasts"] if item in place]
                    if not lasts or not all(item in place for item in candidate["itemset"]):
                        continue
                    stem = np.bitwise_and.reduce(held[[place[item] for item in candidate["itemset"]]], axis=0)
                    found = held[[place[item] for item in lasts]] & stem
                    times = sum(np.bitwise_count(found & digit).sum(axis=1, dtype=np.int64) << k for k, digit in enumerate(digits))
                    itemsets += [[*candidate["itemset"], item] for item, n in zip(lasts, times) if n]
                    occurrences += [int(n) for n in times if n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(itemsets, pa.list_(pa.string())), pa.array(occurrences, pa.int64())], ["itemset", "occurrences"]
                )

    steps = -(-grown.count() // STEP_CANDIDATES)
    step = F.pmod(F.xxhash64("itemset"), F.lit(max(steps, 1)))
    dealt = grown.groupBy(step.alias("number")).agg(F.collect_list(F.struct("itemset", "lasts")).alias("step"))
    counted = blocks.crossJoin(dealt.select("step")).mapInArrow(run, "itemset array<string>, occurrences bigint")
    return counted.groupBy("itemset").agg(F.sum("occurrences").alias("occurrences"))


def _level_wise(pruned: DataFrame, total: Column, min_support: float, max_len: int) -> DataFrame:
    """Frequent sets, one length after another: (itemset, occurrences).

    Baskets are stored once, as bits. Each length is counted on them, candidate by candidate: what
    is written are candidates and their counts, never a row for a set in a basket.
    """
    single = pruned.select(F.explode("kept").alias("item"), "n").groupBy(F.array("item").alias("itemset"))
    counted = single.agg(F.sum("n").alias("occurrences"))
    blocks = _blocks(pruned).checkpoint() if max_len > 1 else None
    found = []
    for size in range(1, max_len + 1):
        frequent = counted.where(F.col("occurrences") / total >= min_support).checkpoint()
        found.append(frequent)
        if size == max_len or frequent.isEmpty():
            break
        counted = _occurrences(blocks, candidate_sets(frequent, size).checkpoint())
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def subsets_of(width: int, max_len: int) -> int:
    """Number of sets of up to ``max_len`` of ``width`` items."""
    return sum(math.comb(width, size) for size in range(1, max_len + 1))


def frequent_itemsets(distinct_baskets: DataFrame, min_support: float = 0.01, max_len: int = 3) -> DataFrame:
    """Item sets in at least ``min_support`` of all baskets: (itemset, occurrences, support).

    Works on distinct baskets, whose number depends on the vocabulary and not on the
    reviews. Infrequent single items are removed first. Where no basket has more than
    ``SUBSETS`` sets, all are counted in one go; wider baskets become blocks of bits, on which
    candidates are counted level by level. Both count the same.
    """
    ensure_checkpoint_dir(distinct_baskets.sparkSession)
    # Numbers hold only for stored rows.
    numbered = distinct_baskets.withColumn("basket", F.monotonically_increasing_id()).checkpoint()
    total = numbered.agg(F.sum("n")).scalar()
    pruned = _pruned(numbered, total, min_support).checkpoint()
    width = pruned.agg(F.max(F.size("kept"))).first()[0] or 0
    if subsets_of(width, max_len) <= SUBSETS:
        counted = _all_subsets(pruned, max_len).groupBy("itemset").agg(F.sum("n").alias("occurrences"))
    else:
        counted = _level_wise(pruned, total, min_support, max_len)
    return counted.withColumn("support", F.col("occurrences") / total).where(F.col("support") >= min_support)


def association_rules(itemsets: DataFrame, min_confidence: float = 0.3) -> DataFrame:
    """Every split of every frequent set into antecedent and consequent that is reliable."""
    last_mask = F.expr("shiftleft(1, size(itemset)) - 2")
    split = (
        itemsets.where(F.size("itemset") > 1)
        .select("itemset", "support", F.explode(F.sequence(F.lit(1), last_mask)).alias("mask"))
        .withColumn(
            "consequent", F.filter("itemset", lambda item, i: F.getbit(F.col("mask"), i) == 1)
        )
        .withColumn("antecedent", F.array_except("itemset", "consequent"))
    )
    support_of = itemsets.select(F.col("itemset").alias("_set"), F.col("support").alias("_support"))
    left = support_of.withColumnsRenamed({"_set": "antecedent", "_support": "antecedent_support"})
    right = support_of.withColumnsRenamed({"_set": "consequent", "_support": "consequent_support"})
    confidence = F.col("support") / F.col("antecedent_support")
    return (
        split.join(left, "antecedent")
        .where(confidence >= min_confidence)
        .join(right, "consequent")
        .select(
            "antecedent",
            "consequent",
            F.round("support", 6).alias("support"),
            F.round(confidence, 6).alias("confidence"),
            F.round(confidence / F.col("consequent_support"), 6).alias("lift"),
        )
    )


def mine_rules(
    reviews_nlp: DataFrame,
    aspects: DataFrame,
    min_support: float = 0.01,
    min_confidence: float = 0.3,
    max_len: int = 3,
) -> DataFrame:
    """Baskets, frequent sets and rules in one go; no baskets give no rules."""
    ensure_checkpoint_dir(reviews_nlp.sparkSession)
    # Few rows with many readers: fixed once instead of planned for every reader.
    distinct_baskets = baskets(reviews_nlp, aspects).checkpoint()
    found = frequent_itemsets(distinct_baskets, min_support, max_len).checkpoint()
    return association_rules(found, min_confidence)


def top_rules(rules: DataFrame, limit: int = 10) -> DataFrame:
    """Rules with the highest lift first."""
    return rules.orderBy(F.desc("lift"), "antecedent", "consequent").limit(limit)
