"""Review, text and question views over the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rehash a scan with fewer splits than cores; scans of many files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def review_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Text, language and file by the key of the order they belong to."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("o_orderkey"),
        F.col("text").alias("review_text"),
        F.col("lang").alias("language"),
        F.col("source").alias("raw_source_file"),
    )


def review_view(spark: SparkSession, folder: str, level: str = "nation", texts: bool = True) -> DataFrame:
    """Orders as reviews, with the document of the same key as text where there is one.

    ``level`` is the branch: "nation" or "region". Without ``texts`` the documents are not read
    and their columns are absent; ids of documents are unique, so the rows are the same. Nation and region have a fixed number
    of rows. Orders, customers and documents grow together, so their joins are left to
    adaptive execution.
    """
    orders = spread(table(spark, folder, "orders"), "o_orderkey")
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    places = nations.select(F.col("n_nationkey").alias("place"), F.col("n_name").alias("branch_name"))
    if level == "region":
        regions = table(spark, folder, "region")
        places = nations.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("place"), F.col("r_name").alias("branch_name")
        )
    reviews = (
        orders.join(customers.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("place"))
    )
    text_columns = ["review_text", "language", "raw_source_file"] if texts else []
    if texts:
        reviews = reviews.join(review_texts(spark, folder), "o_orderkey", "left")
    return reviews.select(
        F.col("o_orderkey").cast("string").alias("review_id"),
        F.lit("tpch").alias("brand_id"),
        F.replace(F.lower("branch_name"), F.lit(" "), F.lit("_")).alias("branch_id"),
        "branch_name",
        F.lit("orders").alias("source"),
        F.col("o_orderdate").cast("timestamp").alias("review_date"),
        F.substring("o_orderpriority", 1, 1).try_cast("double").alias("rating"),
        *text_columns,
        F.lit(False).alias("review_id_is_generated"),
    )


def with_texts(few: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """A few reviews, as a limit leaves them, with their texts; documents are read but not moved."""
    texts = review_texts(spark, folder).withColumn("review_id", F.col("o_orderkey").cast("string"))
    found = texts.drop("o_orderkey").join(F.broadcast(few.select("review_id")), "review_id")
    return few.join(found, "review_id", "left")


def document_view(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews that all have text; the source is the branch."""
    return spread(table(spark, folder, "documents"), "doc_id").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("source").alias("branch_id"),
        F.upper("source").alias("branch_name"),
        F.lit(None).cast("timestamp").alias("review_date"),
        F.col("text").alias("review_text"),
        F.col("lang").alias("language"),
    )


def page_view(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as reviews: text with tags and entities."""
    return spread(table(spark, folder, "pages"), "page_id").select(
        F.col("page_id").cast("string").alias("review_id"), F.col("html").alias("review_text")
    )


def question_view(spark: SparkSession, folder: str) -> DataFrame:
    """User turns as questions."""
    return (
        table(spark, folder, "conversations")
        .where(F.col("role") == "user")
        .select(
            F.concat_ws("-", "conv_id", "turn").alias("question_id"),
            F.col("text").alias("question"),
            "conv_id",
            "turn",
        )
    )
