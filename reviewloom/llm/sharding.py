"""Sharding by sampled splitters: size-weighted key samples give range boundaries, overfull ranges are subdivided."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import cut, uniform

#: Expected sample rows per range; the sample's size depends on the number of ranges only.
SAMPLES_PER_RANGE = 32
#: Rows that a range should hold; more rows make more ranges, not larger ones.
RANGE_ROWS = 1_000_000
#: Ranges per shard at least, so that sorting a range is a small part of a shard.
RANGES_PER_SHARD = 16
KEY = ("group_key", "doc_id", "row_no")


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's size, digest and sort key, stored once.

    The key is (hash of the text, id, row number): equal texts are neighbours, and still any
    number of equal rows can be divided. Storing fixes the row numbers.
    """
    text = F.col(text_col)
    return cut(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("group_key"),
            F.monotonically_increasing_id().alias("row_no"),
        )
    )


def _id_key():
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))


def _sample(rows: DataFrame, rate: float, salt: int) -> pd.DataFrame:
    """Rows drawn with a chance in proportion to their size, with the bytes each stands for."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
    return (
        rows.withColumn("chance", chance)
        .where(uniform(*KEY, F.lit(salt)) < F.col("chance"))
        .select("group_key", _id_key().alias("doc_id"), "row_no", (F.col("size") / F.col("chance")).alias("weight"))
        .toPandas()
        .sort_values(list(KEY), ignore_index=True)
    )


def _quantiles(sample: pd.DataFrame, parts: int) -> list[tuple[int, int, int]]:
    """Keys that divide a sample's weight into equal parts."""
    if parts < 2 or sample.empty:
        return []
    reach = sample["weight"].cumsum().to_numpy()
    places = np.searchsorted(reach, reach[-1] * np.arange(1, parts) / parts)
    # Each column by itself: a row of the frame would turn the 64-bit keys into floats.
    columns = [sample[c].to_numpy(np.int64) for c in KEY]
    return [tuple(int(c[i]) for c in columns) for i in np.unique(places)]


def locate(bounds: np.ndarray, group_key: np.ndarray, doc_id: np.ndarray, row_no: np.ndarray) -> np.ndarray:
    """The range of each key: the number of boundaries at or below it (int64[n, 3] in key order)."""
    first = bounds[:, 0]
    low, high = np.searchsorted(first, group_key, "left"), np.searchsorted(first, group_key, "right")
    # Boundaries that share the first key are compared further, for the rows on such a key only.
    for at in np.unique(low[low < high]):
        end, rows = int(np.searchsorted(first, first[at], "right")), np.flatnonzero((low == at) & (low < high))
        run = bounds[at:end]
        place = np.searchsorted(run[:, 1], doc_id[rows], "left")
        last = np.searchsorted(run[:, 1], doc_id[rows], "right")
        for i in np.unique(place[place < last]):
            same = np.flatnonzero((place == i) & (place < last))
            stop = int(np.searchsorted(run[:, 1], run[i, 1], "right"))
            place[same] = i + np.searchsorted(run[i:stop, 2], row_no[rows[same]], "right")
        high[rows] = at + place
    return high


def with_range(rows: DataFrame, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """Add the range number of each row; the boundaries are as many as the ranges, not the rows."""
    keys = np.array(bounds, np.int64).reshape(-1, 3)

    @F.pandas_udf("int")
    def range_of(group_key: pd.Series, doc_id: pd.Series, row_no: pd.Series) -> pd.Series:
        return pd.Series(locate(keys, group_key.to_numpy(), doc_id.to_numpy(), row_no.to_numpy())).astype("int32")

    return rows.withColumn("range_no", range_of("group_key", _id_key(), "row_no"))


def splitters(rows: DataFrame, n_rows: int, n_bytes: int, n_ranges: int, rounds: int = 3):
    """Boundaries of even ranges, and rows and bytes of each range.

    Ranges with over twice the mean of rows or bytes are subdivided by samples of their own.
    """
    rate = SAMPLES_PER_RANGE * n_ranges / max(n_bytes, 1)
    bounds = _quantiles(_sample(rows, rate, 0), n_ranges)
    for turn in range(rounds + 1):
        ranged = with_range(rows, bounds)
        full = {
            r.range_no: (r.n, r.bytes)
            for r in ranged.groupBy("range_no").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
        }
        over = {
            k: min(int(max(n * n_ranges / n_rows, b * n_ranges / n_bytes)) + 1, n)
            for k, (n, b) in full.items()
            if n > 1 and (n > 2 * n_rows / n_ranges or b > 2 * n_bytes / n_ranges)
        }
        if turn == rounds or not over:
            return bounds, [full.get(k, (0, 0)) for k in range(len(bounds) + 1)]
        # Every row of an overfull range has the same chance here, as it may be full of rows or of bytes.
        found = (
            ranged.where(F.col("range_no").isin(list(over)))
            .where(uniform(*KEY, F.lit(turn + 1)) < SAMPLES_PER_RANGE * n_ranges / n_rows)
            .select("range_no", "group_key", _id_key().alias("doc_id"), "row_no", F.col("size").cast("double").alias("weight"))
            .toPandas()
            .sort_values(list(KEY), ignore_index=True)
        )
        more = [b for k, part in found.groupby("range_no") for b in _quantiles(part.reset_index(drop=True), over[k])]
        bounds = sorted({*bounds, *more})


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every document; shards are consecutive key ranges of near equal bytes.

    Returns doc_id, size, text_crc32, law ("bytes"), shard, slot and grown_shard (null: only the
    "key" law has one). A document belongs to the shard in which the middle of its bytes lies, so
    a shard differs from the mean by at most the two documents at its ends. Null texts have size
    8 and the digest of an empty text; null ids sort first; repeated rows count one by one; an
    empty table gives an empty result. Other columns are not read.
    """
    rows = keyed_rows(docs, id_col, text_col)
    whole = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n_rows, n_bytes = whole.n, whole.bytes or 0
    n_ranges = max(RANGES_PER_SHARD * shards, -(-n_rows // RANGE_ROWS))
    bounds, filled = splitters(rows, max(n_rows, 1), max(n_bytes, 1), n_ranges)
    starts, at_row, at_byte = [], 0, 0
    for k, (n, size) in enumerate(filled):
        starts.append((k, at_row, at_byte))
        at_row, at_byte = at_row + n, at_byte + size
    spark = docs.sparkSession
    # One row per range: bounded by the number of ranges.
    start = spark.createDataFrame(starts, "range_no int, row_start long, byte_start long")
    upto = Window.partitionBy("range_no").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut(
        with_range(rows, bounds)
        .join(F.broadcast(start), "range_no")
        .withColumn("before", F.col("byte_start") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .withColumn("place", F.col("row_start") + F.count("*").over(upto))
        .withColumn("shard", F.expr(f"cast((2 * before + size) * {shards} div {2 * max(n_bytes, 1)} as int)"))
        .select("doc_id", "size", "text_crc32", "shard", "place")
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))  # a row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first_place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents as one Parquet folder per shard, in slot order within each file.

    Ids must be unique here, since they carry the assignment to the texts.
    """
    placed = assigned.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    joined = docs.join(placed, docs[id_col].eqNullSafe(placed["_id"])).drop("_id")
    chunk = F.expr("cast(_slot div 1000000 as int)")  # a large shard is written by several tasks
    (
        joined.repartition("_shard", chunk)
        .sortWithinPartitions("_shard", "_slot")
        .withColumnRenamed("_slot", "slot")
        .withColumnRenamed("_shard", "shard")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
