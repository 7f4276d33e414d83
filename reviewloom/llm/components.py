"""Connected components of a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import written


def _flattened(parents: DataFrame) -> DataFrame:
    """Follow parents (node, up) to their roots; each step halves the longest way."""
    while True:
        up = parents.select(F.col("node").alias("up"), F.col("up").alias("further"))
        parents = written(parents.join(up, "up", "left").select("node", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), "parents")
        if parents.where("moved").isEmpty():
            return parents.drop("moved")
        parents = parents.drop("moved")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (a, b); a component is its smallest node."""
    spark = links.sparkSession
    current = written(links.where("a != b").select("a", "b"), "links")
    labels = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).where("up < node")
        parents = _flattened(hooks)
        a, b = parents.select(F.col("node").alias("a"), F.col("up").alias("pa")), parents.select(F.col("node").alias("b"), F.col("up").alias("pb"))
        current = written(
            current.join(a, "a", "left").join(b, "b", "left")
            .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
            .where("a != b").distinct(),
            "links",
        )
        if labels is None:
            labels = parents
        else:
            up = parents.select(F.col("node").alias("up"), F.col("up").alias("further"))
            moved = labels.join(up, "up", "left").select("node", F.coalesce("further", "up").alias("up"))
            # Nodes that were roots before and hook now.
            labels = written(moved.unionByName(parents.join(labels.select("node"), "node", "left_anti")), "labels")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    roots = labels.select(F.col("up").alias("node")).distinct().withColumn("up", F.col("node"))
    return labels.unionByName(roots.join(labels.select("node"), "node", "left_anti")).withColumnRenamed("up", "component")
