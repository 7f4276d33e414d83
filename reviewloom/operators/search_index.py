"""Substring search over stored texts: posting lists of character trigrams, verified on the texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.rows import unnest
from reviewloom.functions.text import snippet
from reviewloom.operators.lookups import SEARCH_COLUMNS, of_branch, search_feedback
from reviewloom.session import ensure_checkpoint_dir

GRAM = 3
#: Bits of a text's number within its block; a posting list covers one block, so it is never long.
BLOCK_BITS = 12
#: Folders of posting lists; a search opens those of its trigrams only.
SHELVES = 256
#: Characters whose trigrams are sorted at a time (or one text).
RUN_CHARACTERS = 4_000_000
#: Files of a folder; a list's file follows from its trigram and block, so that no folder is one task.
SHELF_PARTS = 4
#: Candidates that are verified in the first step of a search; each further step takes twice as many, up to the most.
FIRST_STEP, MOST_STEP = 256, 16_384


@dataclass(frozen=True)
class SearchIndex:
    """Stored texts in the order of their ids, and posting lists by trigram and block."""

    texts: DataFrame
    postings: DataFrame


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """Neighbouring texts of one block and at most ``RUN_CHARACTERS``: block, texts, places."""
    texts, places = batch["text"].to_pylist(), batch["place"].to_numpy()
    blocks = batch["block"].to_numpy()
    first, characters = 0, 0
    for at, text in enumerate(texts):
        if at > first and (blocks[at] != blocks[first] or characters + len(text) > RUN_CHARACTERS):
            yield int(blocks[first]), texts[first:at], places[first:at]
            first, characters = at, 0
        characters += len(text)
    if texts:
        yield int(blocks[first]), texts[first:], places[first:]


def _run_lists(block: int, texts: list[str], places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Posting lists of a few texts of a block, by trigrams of code points.

    A trigram and its text are one number: the ranks of three letters among those of the run, then
    the text's. Texts with too many letters for that are taken in halves; one text always fits.
    """
    lengths = np.array([len(text) for text in texts])
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    seen = np.zeros(0x110000, bool)
    seen[letters] = True
    alphabet = np.flatnonzero(seen)
    width, owner = max(len(alphabet) - 1, 0).bit_length(), (len(texts) - 1).bit_length()
    if 3 * width + owner > 63:
        half = len(texts) // 2
        yield from _run_lists(block, texts[:half], places[:half])
        yield from _run_lists(block, texts[half:], places[half:])
        return
    ranks = (np.cumsum(seen) - 1)[letters]
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(letters))
    at = np.flatnonzero(left >= GRAM)
    grams = (ranks[at] << width | ranks[at + 1]) << width | ranks[at + 2]
    keys = np.sort(grams << owner | np.repeat(np.arange(len(texts)), lengths)[at])
    kept = np.ones(len(keys), bool)
    kept[1:] = keys[1:] != keys[:-1]
    keys = keys[kept]
    grams, found = keys >> owner, places[keys & ((1 << owner) - 1)]
    first = np.ones(len(keys), bool)
    first[1:] = grams[1:] != grams[:-1]
    starts, codes, last = np.flatnonzero(first), grams[first], (1 << width) - 1
    spelled = alphabet[np.column_stack([codes >> 2 * width, codes >> width & last, codes & last])] if len(codes) else alphabet[:0]
    names = spelled.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([names[i : i + GRAM] for i in range(0, len(names), GRAM)], pa.string()),
            pa.array(np.full(len(codes), block), pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.append(starts, len(keys)), pa.int32()), pa.array(found, pa.int32())),
        ],
        ["gram", "block", "places"],
    )


def _gram_lists(texts: DataFrame) -> DataFrame:
    """(gram, block, places): lists of neighbouring texts, so a text's trigrams are no rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, few, places in _runs(batch):
                yield from _run_lists(block, few, places)

    return texts.select("block", "place", "text").mapInArrow(run, "gram string, block long, places array<int>")


def shelf(gram: Column) -> Column:
    """Folder of a trigram's posting lists."""
    return (F.crc32(gram.cast("binary")) % SHELVES).cast("int")


def build_search_index(reviews: DataFrame, path: str) -> SearchIndex:
    """Write the index of cleaned reviews under ``path`` and open it.

    Texts are numbered in the order of ``review_id``, nulls first, so the first hits by number are
    the first by id. Reviews without a text are left out, as no search finds them. A list holds
    the texts of one block of 4,096 that have a trigram, so a trigram of all texts is many short lists.
    """
    spark = reviews.sparkSession
    ensure_checkpoint_dir(spark)
    # The range sort reads its input twice, so the texts are fixed first.
    kept = reviews.select(*SEARCH_COLUMNS).where(F.col("cleaned_text").isNotNull()).checkpoint()
    ordered = kept.repartitionByRange(F.asc_nulls_first("review_id")).sortWithinPartitions(F.asc_nulls_first("review_id"))
    ordered.select(F.monotonically_increasing_id().alias("text_no"), "*").write.mode("overwrite").parquet(f"{path}/texts")
    texts = spark.read.parquet(f"{path}/texts")
    located = texts.select(
        F.shiftright("text_no", BLOCK_BITS).alias("block"),
        F.col("text_no").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("place"),
        F.lower("cleaned_text").alias("text"),
    )
    key = ("shelf", "part", "gram", "block")
    part = F.pmod(F.xxhash64("gram", "block"), F.lit(SHELF_PARTS))
    dealt = _gram_lists(located).withColumns({"shelf": shelf(F.col("gram")), "part": part}).repartition("shelf", "part")
    # All lists of a trigram and block are in one place: no further shuffle.
    lists = dealt.groupBy(*key).agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("places"))
    shelved = lists.select("gram", "block", "places", "shelf").sortWithinPartitions("shelf", "gram", "block")
    shelved.write.mode("overwrite").partitionBy("shelf").parquet(f"{path}/postings")
    return open_search_index(spark, path)


def open_search_index(spark: SparkSession, path: str) -> SearchIndex:
    """An index that was built before."""
    lists = spark.read.schema("gram string, block long, places array<int>, shelf int").parquet(f"{path}/postings")
    return SearchIndex(spark.read.parquet(f"{path}/texts"), lists)


def candidates(index: SearchIndex, query: str) -> DataFrame:
    """Numbers of the texts that have all trigrams of a query of three characters or more."""
    lowered = query.lower()
    grams = sorted({lowered[i : i + GRAM] for i in range(len(lowered) - GRAM + 1)})
    shelves = sorted({zlib.crc32(gram.encode()) % SHELVES for gram in grams})
    lists = index.postings.where(F.col("shelf").isin(shelves) & F.col("gram").isin(grams))
    # A block's lists: at most one for each trigram, of at most 4,096 places.
    blocks = lists.groupBy("block").agg(F.collect_list("places").alias("lists")).where(F.size("lists") == len(grams))
    smallest_first = F.array_sort(F.transform("lists", lambda x: F.struct(F.size(x).alias("n"), x.alias("places"))))
    both = F.aggregate(F.slice(smallest_first, 2, len(grams)), smallest_first[0]["places"], lambda a, x: F.array_intersect(a, x["places"]))
    places = unnest(blocks, both, "place", "block")
    return places.select((F.shiftleft("block", BLOCK_BITS) + F.col("place")).alias("text_no"))


def search(index: SearchIndex, query: str, branch_id: str | None = None, limit: int = 10) -> DataFrame:
    """Reviews whose cleaned text contains the query, any case; the lowest ids first.

    The same rows as ``search_feedback``. Candidates are verified in ascending order until
    ``limit`` texts are found; what comes to the driver are numbers of one step. A query of less
    than three characters has no trigram and is looked for in all texts.
    """
    if len(query.lower()) < GRAM:
        return search_feedback(index.texts, query, branch_id, limit)
    matching = index.texts.where(F.contains(F.lower("cleaned_text"), F.lit(query.lower())))
    matching = matching if branch_id is None else of_branch(matching, branch_id)
    every, found, last, step = candidates(index, query), [], -1, FIRST_STEP
    while len(found) < limit:
        numbers = [r.text_no for r in every.where(F.col("text_no") > last).orderBy("text_no").limit(step).collect()]
        if numbers:
            near = matching.where(F.col("text_no").between(numbers[0], numbers[-1]))
            asked = index.texts.sparkSession.createDataFrame([(n,) for n in numbers], "text_no long")  # one step
            hits = near.join(F.broadcast(asked), "text_no", "left_semi").orderBy("text_no").limit(limit - len(found))
            found += [r.text_no for r in hits.select("text_no").collect()]
        if len(numbers) < step:
            break
        last, step = numbers[-1], min(2 * step, MOST_STEP)
    chosen = index.texts.where(F.col("text_no").isin(found))
    shown = {"cleaned_text": snippet(F.col("cleaned_text"))}
    return chosen.orderBy("text_no").select(*(shown.get(c, F.col(c)).alias(c) for c in SEARCH_COLUMNS))
