"""Concatenate and cut: token ids of all documents as one stream, cut into windows of fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import id_and_text, text_slices, written
from reviewloom.llm.tokens import PieceEncoder, default_path

CAPACITY = 2048
END_ID = 1
#: Partitions whose totals are added up in one group.
TOTALS_BLOCK = 1024


def token_stream(docs: DataFrame, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every document, stored once: the first pass.

    Returns part, part_start (ids of the part before the document), doc_id, doc_tokens and ids
    (little-endian numbers of two bytes, or of four if the ids need it). A part is what one
    task read, so its own prefix sums need no shuffle.
    """
    path = path or default_path("byte_bpe_50k.json")
    schema = pa.schema([("part", pa.int32()), ("part_start", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part_no, reach = PieceEncoder(path, "spaces"), TaskContext.get().partitionId(), 0
        kind = np.dtype("<u2" if max(encoder.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4")
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text"))
                ids = np.insert(ids, offsets[1:], end_id).astype(kind)
                ends = offsets + np.arange(len(offsets))
                n = part.num_rows
                data = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((ends * kind.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part_no, np.int32)), pa.array(reach + ends[:-1]), part.column("doc_id"), pa.array(np.diff(ends)), data], schema=schema)
                reach += int(ends[-1])

    narrow = id_and_text(docs, id_col, text_col)
    return written(narrow.mapInArrow(encode, "part int, part_start long, doc_id long, doc_tokens long, ids binary"), "token-stream")


def part_offsets(stream: DataFrame) -> DataFrame:
    """part and before (ids of all parts before it), from the totals of the parts.

    Totals are added up in two levels, blocks of parts and parts of a block, so no group grows
    with the table.
    """
    totals = written(stream.groupBy("part").agg(F.sum("doc_tokens").alias("n")).withColumn("block", F.expr(f"part div {TOTALS_BLOCK}")), "part-totals")
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n"))
    above = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each TOTALS_BLOCK tasks
    starts = blocks.select("block", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("block_start"))
    within = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    summed = totals.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return written(summed.join(starts, "block").select("part", (F.col("block_start") + F.col("own")).alias("before")), "part-offsets")


def _decoded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch one after another, and the number of ids of each row."""
    column = batch.column("ids")
    count = np.asarray(batch.column("doc_tokens")).astype(np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    width = int(bounds[-1] - bounds[0]) // max(int(count.sum()), 1)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return raw.view(f"<u{width}").astype("<u4") if len(raw) else np.zeros(0, "<u4"), count


def _cut(capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in text_slices(whole, "ids")):
            ids, count = _decoded(batch)
            begin = np.cumsum(count) - count
            at = np.asarray(batch.column("at")).astype(np.int64)
            first = at // capacity
            pieces = (at + count - 1) // capacity - first + 1
            doc = np.repeat(np.arange(len(count)), pieces)
            window = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            low = np.maximum(window * capacity, at[doc])
            high = np.minimum((window + 1) * capacity, (at + count)[doc])
            a = begin[doc] + low - at[doc]
            b = a + high - low
            crc = [zlib.crc32(ids[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            row = pa.array(doc)
            arrays = [
                batch.column("doc_id").take(row), pa.array(low - at[doc]), pa.array(high - low), pa.array(crc, pa.int64()),
                batch.column("doc_tokens").take(row), pa.array(window), pa.array(low - window * capacity),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(np.append(a, len(ids)), pa.int32()), pa.array(ids.astype(np.int64))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def concatenate_and_cut(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in windows of ``capacity`` ids; only the last window isn't full.

    Returns doc_id, start, length, ids_crc32 (of the ids as little-endian 32-bit numbers),
    doc_tokens (with the end id), sequence_id, offset and, with ``with_ids``, the ids. The first
    pass encodes and stores every text with prefix sums of its part; the totals of the parts give
    each part its place in the whole stream; the second pass cuts what is stored, without a
    shuffle. A null text is empty and has the end id alone; null ids and repeated rows are
    documents like others; an empty table gives no rows; other columns are not read. The order
    of documents is that of the table's parts. A task holds about 4 MB of texts, or one longer
    text, at a time.
    """
    stream = token_stream(docs, path, end_id, id_col, text_col)
    placed = stream.join(part_offsets(stream), "part").withColumn("at", F.col("before") + F.col("part_start"))
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<long>" * with_ids
    return placed.select("doc_id", "doc_tokens", "at", "ids").mapInArrow(_cut(capacity, with_ids), kind)


def _windows(capacity: int):
    """Whole windows of runs of consecutive pieces, and the pieces at a run's ends as boundary records."""
    schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int64())), ("whole", pa.bool_())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, begin, reach, held = None, 0, 0, []

        def record() -> dict:
            return {"sequence_id": window, "offset": begin, "ids": np.concatenate(held).tolist(), "whole": begin == 0 and reach == capacity}

        for batch in batches:
            out = []
            lists = batch.column("ids")
            bounds, flat = np.asarray(lists.offsets).tolist(), np.asarray(lists.values)
            for k, (number, offset) in enumerate(zip(batch.column("sequence_id").to_pylist(), batch.column("offset").to_pylist(), strict=True)):
                if (number, offset) != (window, reach):
                    out += [record()] if held else []
                    window, begin, reach, held = number, offset, offset, []
                held.append(flat[bounds[k] : bounds[k + 1]])
                reach += bounds[k + 1] - bounds[k]
                if reach == capacity:
                    out.append(record())
                    window, begin, reach, held = None, 0, 0, []
            yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([record()], schema)

    return collect


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and ids of every window, from pieces with ids.

    A task puts the windows together that lie wholly in what it reads; only boundary records, a
    few for each part, are shuffled and joined by their window. The last window may be shorter.
    """
    found = written(pieces.select("sequence_id", "offset", "ids").mapInArrow(_windows(capacity), "sequence_id long, offset long, ids array<long>, whole boolean"), "windows")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # of one window: at most ``capacity`` records
    joined = found.where("NOT whole").groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    return found.where("whole").select("sequence_id", "ids").unionByName(joined)
