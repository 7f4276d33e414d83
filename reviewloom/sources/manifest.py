"""Lineage of one ingestion run."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.quality import count_by, count_map
from reviewloom.sources.raw_json import ReviewSource, source_labels

DATA_STATUS = "real_input_with_derived_normalization"
#: Bytes of a file that a task holds at a time.
CHUNK_BYTES = 8 << 20
#: Schemes of file systems that tasks open by themselves.
CHUNKED_SCHEMES = ("file", "s3", "s3a", "gs")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each file, read a chunk at a time."""
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            if path.startswith("/"):
                system, place = pyarrow.fs.LocalFileSystem(), path
            else:
                uri = quote(re.sub("^s3a:", "s3:", path), safe="/:")
                system, place = pyarrow.fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            # Without a codec, so that a packed file is hashed as it lies there.
            with system.open_input_stream(place, compression=None) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield batch.append_column("sha256", pa.array(found, pa.string()))


def file_digests(
    spark: SparkSession, paths: list[str] | str, chunked: Collection[str] = CHUNKED_SCHEMES
) -> DataFrame:
    """Size and SHA-256 of every file: (path, file_name, size_bytes, sha256).

    Files are hashed in parallel, each one by one task. Where all lie on file systems that tasks
    can open by themselves (``chunked``, by scheme), a file may have any size and a task holds one
    chunk of it. Elsewhere Spark's reader brings each file whole, up to 2 GB. Empty files hold no
    records, and Spark's listing leaves them out.
    """
    files = spark.read.format("binaryFile").load(paths)
    # The binary reader's paths are not encoded, unlike those of a row's metadata.
    plain, size = F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("length").alias("size_bytes")
    others = files.where(~F.regexp_extract("path", "^([A-Za-z0-9+.-]+):", 1).isin(list(chunked)))
    if others.select("path").isEmpty():
        # Without its content column the reader lists files and opens none.
        hashed = files.select(plain, size).mapInArrow(_digests, "path string, size_bytes bigint, sha256 string")
    else:
        hashed = files.select(plain, size, F.sha2("content", 256).alias("sha256"))
    return hashed.select(
        "path", F.regexp_extract("path", "[^/]*$", 0).alias("file_name"), "size_bytes", "sha256"
    )


def source_files(spark: SparkSession, sources: Iterable[ReviewSource]) -> DataFrame:
    """One row per source file: its branch and brand, size and digest."""
    chosen = list(sources)
    digests = file_digests(spark, [s.path for s in chosen])
    return digests.select("*", source_labels(chosen, F.col("path")).alias("labels")).select(
        "path", "file_name", "labels.branch_id", "labels.branch_name", "labels.brand_id", "size_bytes", "sha256"
    )


def manifest_tables(
    spark: SparkSession, sources: Iterable[ReviewSource], reviews: DataFrame
) -> dict[str, DataFrame]:
    """The manifest's lists as tables, for runs of more files than one row should hold."""
    return {
        "source_files": source_files(spark, sources),
        "records_by_branch": count_by(reviews, "branch_id"),
        "records_by_source_file": count_by(reviews, "raw_source_file"),
    }


def build_manifest(
    spark: SparkSession, sources: Iterable[ReviewSource], reviews: DataFrame, output_path: str
) -> DataFrame:
    """One row: source files with digests, where the output went, and counts."""
    tables = manifest_tables(spark, sources, reviews)
    files = tables["source_files"]
    return files.agg(F.array_sort(F.collect_list(F.struct(*files.columns))).alias("source_files")).select(
        F.lit(1).alias("manifest_version"),
        F.current_timestamp().alias("created_at_utc"),
        F.lit(DATA_STATUS).alias("data_status"),
        "source_files",
        F.struct(
            F.lit(output_path).alias("path"),
            reviews.agg(F.count("*")).scalar().alias("record_count"),
        ).alias("normalized_output"),
        count_map(tables["records_by_branch"], "branch_id").alias("records_by_branch"),
        count_map(tables["records_by_source_file"], "raw_source_file").alias("records_by_source_file"),
    )
