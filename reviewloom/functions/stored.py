"""Steps of a loop: stored in the shared folder and deleted when nothing refers to them."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from reviewloom.session import ensure_checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped
        return
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Steps planned here give back their shuffle files when they are done."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Stored:
    """Rows as Parquet below the checkpoint folder, for as long as this object lives.

    Shuffle files of the step that makes them go as soon as it is done; a loop of many steps would
    keep them all until the driver collects garbage.
    """

    def __init__(self, df: DataFrame, name: str) -> None:
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
        with shuffles_removed(spark):
            df.select("*").write.parquet(path, compression="zstd")  # planned anew, so that the setting holds for it
        self.rows = spark.read.schema(df.schema).parquet(path)
        weakref.finalize(self, _delete, spark, path).atexit = False
