"""From raw documents to packed training sequences, stage by stage.

Language ID drops documents without a recognised language, near duplicates leave one document of
each group, repeated passages are cut out, sources are mixed to their target weights, and the
result is packed into sequences of 2048 tokens. Every stage but the last returns the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import language, minhash, mixing, packing, suffixes
from reviewloom.llm.common import shared_folder, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their labelled neighbours have."""
    return language.keep_identified(docs, language.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return minhash.one_per_group(docs, percent=80, width=5)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document has in 50 bytes or more."""
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.pack(packing.tokenized_pieces(docs))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Mixing draws documents by chance, which SQL can't repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
