"""Helpers the corpus operators share: tables, storage between steps, bounded Arrow slices."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import ensure_checkpoint_dir

#: The white space that separates words in every operator here.
SPACE = " \t\n\x0b\f\r"
#: Text bytes that one numpy step works on, whatever the Arrow batch holds.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_place(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The frame with its columns called c0, c1, ... and what ``names`` are called then.

    So columns beside those that an operator reads may have any name, also one that differs from
    them in case only or holds dots.
    """
    columns = df.columns
    return df.toDF(*[f"c{i}" for i in range(len(columns))]), [f"c{columns.index(name)}" for name in names]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id (long) and text of every document."""
    frame, (doc_id, text) = by_place(docs, id_col, text_col)
    return frame.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Store the rows in the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Store the rows as Parquet in the shared folder; unlike a checkpoint their size is known, so small ones are broadcast."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete the folders of frames that ``written`` gave and nothing will read again."""
    for df in stored:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids get 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def uniform(*columns) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts together hold about ``most`` bytes."""
    if not batch.num_rows:
        return
    values = batch.column(column)
    sizes = np.diff(np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4).astype(np.int64))
    part = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *edges], [*edges, len(values)], strict=True):
        yield batch.slice(start, end - start)
    give_back()


def give_back() -> None:
    """Return freed memory to the system; a worker would keep it for its next tasks otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some systems' C library has it
    if trim is not None:
        trim(0)


def raw_text(values: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text array and the n + 1 offsets into them; null is empty."""
    if values.null_count:
        values = values.fill_null("")
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4).astype(np.int64)
    data = values.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))
