"""Queries of the corpus operators: each runs its operator on a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (
    codes, language, middles, minhash, mixing, neighbours, oracles, packing, quality, sharding, suffixes, tokenfiles, toxicity, windows,
)
from reviewloom.llm.common import remainder, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 24)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 50-byte strings of documents before it."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(packing.tokenized_pieces(table(spark, sf_dir, "documents")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the rule cascade."""
    # Which rule rejects first depends on measured costs, so it isn't part of the result.
    return quality.quality(table(spark, sf_dir, "documents")).drop("rejected_by")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned without a quarter of the ids."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(language.train_part(docs)))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to 5 : 2 : 1 of 150 % of all words."""
    drawn = mixing.mix(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, read back."""
    return tokenfiles.token_files(table(spark, sf_dir, "documents")).drop("path")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned without a fifth of the ids."""
    labels = toxicity.train_part(table(spark, sf_dir, "labels"))
    scored = toxicity.score(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op11_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, and the text rebuilt from it."""
    found = middles.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": middles.restored(F.col("output"), F.col("form"))}
    hashed = [F.sha2(value.cast("binary"), 256).alias(name) for name, value in digests.items()]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashed)


def op12_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one stream of ids, cut into windows of 2048."""
    return windows.concatenate_and_cut(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte codes of all vectors."""
    return codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every corpus query by name."""
    return {
        "op1_sharding": op1_sharding,
        "op2_minhash": op2_minhash,
        "op3_suffixes": op3_suffixes,
        "op4_packing": op4_packing,
        "op5_quality": op5_quality,
        "op6_language": op6_language,
        "op7_neighbours": op7_neighbours,
        "op8_mixing": op8_mixing,
        "op9_token_files": op9_token_files,
        "op10_toxicity": op10_toxicity,
        "op11_middles": op11_middles,
        "op12_windows": op12_windows,
        "op13_codes": op13_codes,
    }


def all_oracles() -> dict[str, str]:
    """DuckDB SQL of the corpus queries that SQL can express."""
    return oracles.all_oracles()
