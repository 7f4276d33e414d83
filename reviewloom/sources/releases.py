"""Result tables that change together.

A run writes its tables to a folder of its own and, when all of them are there, appends one row to
the list of releases. The row is one file, so it is there or not. Readers take the folder of
the last row: they see the old set or the new one, never a mixture, and a run that is lost
half-way leaves the old set as it was. Folders of earlier releases stay until ``expire``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.schemas import TABLES
from reviewloom.sources.tables import empty_table, read_json, read_table, write_table

#: ``run`` is the folder below the root, so that a root may be moved or reached by another address.
RELEASE = (
    T.StructType()
    .add("number", T.LongType())
    .add("run", T.StringType())
    .add("published_at", T.TimestampType())
)


def new_run() -> str:
    """Name of a run's folder below the root."""
    return f"runs/{uuid.uuid4().hex}"


def releases(spark: SparkSession, root: str) -> DataFrame:
    """Every release, the current one first; a root without any has none.

    Runs that were published at the same time may share a number; all readers then take the
    same one of them, by name.
    """
    return read_json(spark, f"{root}/releases", RELEASE).orderBy(F.desc("number"), F.desc("run"))


def publish(spark: SparkSession, root: str, run: str) -> int:
    """Make a finished run the current release."""
    last = releases(spark, root).first()
    number = (last["number"] if last else 0) + 1
    row = spark.range(1).coalesce(1).select(
        F.lit(number).cast("bigint").alias("number"), F.lit(run).alias("run"), F.current_timestamp().alias("published_at")
    )
    row.write.mode("append").json(f"{root}/releases")
    return number


def write_release(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame | Callable[[str], DataFrame]]
) -> int:
    """Write named tables, in their order, and publish them as one.

    A table may be a function of the run's folder, to read what was written before it.
    """
    run = new_run()
    for name, table in tables.items():
        write_table(table(f"{root}/{run}") if callable(table) else table, f"{root}/{run}", name)
    return publish(spark, root, run)


def read_release(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """Every named table of the current or a given release; empty ones where there is no release.

    What was read stays the same when a later run is published.
    """
    found = releases(spark, root)
    chosen = (found if number is None else found.where(F.col("number") == number)).first()
    if chosen is None:
        if number is not None:
            raise ValueError(f"no release {number} in {root}")
        return {name: empty_table(spark, name) for name in TABLES}
    return {name: read_table(spark, f"{root}/{chosen['run']}", name) for name in TABLES}


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the last releases and return their names.

    Tables still open from them can't be read any more. Folders of unpublished runs are left alone.
    """
    if keep < 1:
        raise ValueError("the current release must be kept")
    old = [row["run"] for row in releases(spark, root).collect()[keep:]]
    removed = []
    for run in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{run}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            removed.append(run)
    return removed
