"""Best-fit packing with large-item matching, decided on the histogram of lengths."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import cut, id_and_text, text_slices
from reviewloom.llm.tokens import PieceEncoder, default_path

CAPACITY = 2048
END_ID = 0
#: Pieces of one length that are numbered together.
BLOCK_ROWS = 200_000


def tokenized_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every document with the end id, cut into pieces of at most ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32 (of the ids as little-endian 32-bit numbers)
    and, with ``with_ids``, the ids. Only longer documents are cut; their first piece takes what
    is left over, all others are full. A null text is empty and so has the end id alone.
    """
    path = path or default_path("byte_bpe_50k.json")
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path, "spaces")
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text"))
                n = np.diff(offsets) + 1
                ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
                offsets = np.concatenate([[0], np.cumsum(n)])
                parts = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                short = n - (parts - 1) * capacity  # the first piece
                start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, short[doc], capacity)
                begin = offsets[doc] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                arrays = [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    ends = np.concatenate([begin, [len(ids)]]) if len(begin) else np.zeros(1)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in kind.split(", ")])

    narrow = id_and_text(docs, id_col, text_col)
    return narrow.mapInArrow(cut_up, kind)


def matched_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Pack ``counts`` items of each length; returns runs (length, rank, items, bin, per bin, offset).

    The items of a run have consecutive ranks among those of their length and fill consecutive
    bins from ``bin`` on, ``per bin`` in each, from ``offset`` on. Items above a third of the
    capacity are matched first, the longest with the longest that still fits, so at most two to
    a bin. Each shorter length then goes, longest first, to the bins with the smallest gap that
    holds it. The work depends on the number of lengths, not of items.
    """
    left, used, runs, bins = dict(counts), dict.fromkeys(counts, 0), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> groups of (first bin, bins)

    def place(length: int, items: int, first: int, per: int, offset: int) -> None:
        runs.append((length, used[length], items, first, per, offset))
        used[length] += items
        left[length] -= items

    large = sorted(k for k in counts if 3 * k > capacity)
    while large:
        top = large[-1]
        if not left[top]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - top) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        mate = large[at] if at >= 0 else None
        if mate == top:
            n = left[top] // 2
            if n:
                place(top, 2 * n, bins, 2, 0)
            gap = capacity - 2 * top
            if not n:
                at = at - 1
                n, gap = 1, capacity - top
                place(top, 1, bins, 1, 0)
                if at >= 0 and left[large[at]]:
                    place(large[at], 1, bins, 1, top)
                    gap -= large[at]
        elif mate is not None:
            n = min(left[top], left[mate])
            place(top, n, bins, 1, 0)
            place(mate, n, bins, 1, top)
            gap = capacity - top - mate
        else:
            n, gap = left[top], capacity - top
            place(top, n, bins, 1, 0)
        gaps.setdefault(gap, []).append((bins, n))
        bins += n
    order = sorted(g for g in gaps if g)
    for length in sorted((k for k in counts if 3 * k <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                per = capacity // length
                n = -(-left[length] // per)
                gaps.setdefault(capacity, []).append((bins, n))
                bins += n
                order.append(capacity)
                at = len(order) - 1
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            per = gap // length
            full = min(n, left[length] // per)  # bins that take as many as they hold
            rest = [(first, full, per), (first + full, int(n > full and left[length] % per > 0), left[length] % per)]
            done = 0
            for begin, some, each in rest:
                if some:
                    place(length, some * each, begin, each, capacity - gap)
                    done += some
                    smaller = gap - each * length
                    if smaller:
                        if smaller not in gaps:
                            bisect.insort(order, smaller)
                        gaps.setdefault(smaller, []).append((begin, some))
            if n > done:
                if gap not in gaps:
                    bisect.insort(order, gap)
                gaps.setdefault(gap, []).append((first + done, n - done))
    return runs


def ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0 on, in blocks so that no length is one group."""
    blocks = max(1, -(-pieces.count() // BLOCK_ROWS))
    rows = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row_no"), F.lit(blocks)).cast("int"))
    sizes = rows.groupBy("length", "block").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "block", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece", "row_no"))
    return rows.withColumn("own", own).join(before, ["length", "block"]).withColumn("rank", F.col("before") + F.col("own") - 1).drop("block", "before", "own")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Put pieces (rows with doc_id, piece, length, ids_crc32) into sequences of at most ``capacity``.

    Adds sequence_id and offset (the places of a sequence have no gaps). What is collected and
    sent to the tasks depends on the number of different lengths, which ``capacity`` bounds.
    Equal pieces are interchangeable; an empty table gives no rows.
    """
    stored = cut(pieces.withColumn("row_no", F.monotonically_increasing_id()))
    counts = {r.length: r.n for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(sorted(matched_runs(counts, capacity)), np.int64).reshape(-1, 6)
    keys = runs[:, 0] << 44 | runs[:, 1]  # length, then rank

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted = length.to_numpy(np.int64) << 44 | rank.to_numpy(np.int64)
        run = runs[np.searchsorted(keys, wanted, "right") - 1]
        within = rank.to_numpy(np.int64) - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + within // run[:, 4], "offset": run[:, 5] + within % run[:, 4] * run[:, 0]})

    placed = ranked(stored).withColumn("at", place("length", "rank"))
    return placed.select(*pieces.columns, "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed pieces with ids; at most ``capacity`` each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
