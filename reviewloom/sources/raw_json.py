"""Raw review exports: one VARIANT per record, then a typed projection."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.values import parse_timestamp
from reviewloom.schemas import NORMALIZED_COLUMNS
from reviewloom.sources.json_arrays import read_arrays

SOURCE_NAME = "google_maps"


@dataclass(frozen=True)
class ReviewSource:
    """A file, or a folder of array files or JSON Lines shards, and the labels of its reviews."""

    path: str
    branch_id: str
    branch_name: str
    brand_id: str = "brand"


# -- reading -----------------------------------------------------------------


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """JSON Lines files, which split over tasks: (raw, path)."""
    records = spark.read.option("mode", "FAILFAST").option("singleVariantColumn", "raw").json(paths)
    return records.select("raw", F.col("_metadata.file_path").alias("path"))


# -- projection --------------------------------------------------------------


def _text(path: str, raw: str = "raw") -> Column:
    return F.try_variant_get(raw, path, "string")


def _has_key(name: str, raw: str = "raw") -> Column:
    # A key whose value is JSON null gives a variant null, which is not SQL null.
    return F.try_variant_get(raw, f"$.{name}", "variant").isNotNull()


def _rating(name: str) -> Column:
    return F.try_variant_get("raw", f"$.{name}", "double")


def _spelled(path: str) -> Column:
    """Text of any value; booleans are capitalised."""
    text = _text(path)
    is_boolean = F.schema_of_variant(F.try_variant_get("raw", path, "variant")) == "BOOLEAN"
    return F.when(text.isin("true", "false") & is_boolean, F.initcap(text)).otherwise(text)


def fallback_id(branch_id: Column) -> Column:
    """Stable id of a record without one: a digest over branch, author, text and dates."""
    fields = ("reviewerId", "author", "text", "publishedAtDate", "publishedAt")
    parts = [
        F.coalesce(
            _text(f"$.{name}"), F.to_json(F.try_variant_get("raw", f"$.{name}", "variant")), F.lit("None")
        )
        for name in fields
    ]
    digest = F.sha2(F.concat_ws("|", branch_id, *parts), 256)
    return F.concat(F.lit("generated-"), F.substring(digest, 1, 24))


def normalize(records: DataFrame) -> DataFrame:
    """Typed reviews from ``raw`` plus label columns; elements that are no objects are dropped.

    A record is nested when it has the key ``place`` or ``author``, even with a null.
    """
    objects = records.where(F.try_variant_get("raw", "$", "map<string,variant>").isNotNull())
    nested = F.col("_nested")

    def pick(when_nested: str, when_flat: str) -> Column:
        return F.when(nested, _text(when_nested)).otherwise(_text(when_flat))

    given_id = F.nullif(_text("$.reviewId"), F.lit(""))
    return (
        objects.withColumn("_nested", _has_key("place") | _has_key("author"))
        .withColumn("_id", given_id)
        .withColumns(
            {
                "review_id": F.coalesce("_id", fallback_id(F.col("branch_id"))),
                "place_name_raw": pick("$.place.name", "$.title"),
                "source": F.lit(SOURCE_NAME),
                "review_date": parse_timestamp(pick("$.publishedAt", "$.publishedAtDate")),
                "rating": F.coalesce(_rating("rating"), F.when(~nested, _rating("stars"))),
                "review_text": _spelled("$.text"),
                "language": _text("$.language"),
                "owner_response_text": pick("$.ownerResponse.text", "$.responseFromOwnerText"),
                "owner_response_date": parse_timestamp(
                    pick("$.ownerResponse.date", "$.responseFromOwnerDate")
                ),
                "review_url": pick("$.url", "$.reviewUrl"),
                "reviewer_id": pick("$.author.id", "$.reviewerId"),
                "reviewer_name": pick("$.author.name", "$.name"),
                "review_id_is_generated": F.col("_id").isNull(),
            }
        )
        .select(*NORMALIZED_COLUMNS)
    )


# -- several sources ---------------------------------------------------------


def plain_path(path: Column) -> Column:
    """A file URI as the path a user would write."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def source_labels(sources: Iterable[ReviewSource], path: Column) -> Column:
    """Brand and branch labels for a plain path, by the file itself or by its folder.

    The sources are configuration, so they are one literal map and not a join.
    """
    entries: list[Column] = []
    for source in sources:
        key = re.sub("^file:/+", "/", unquote(source.path)).rstrip("/")
        labels = F.struct(
            F.lit(source.brand_id).alias("brand_id"),
            F.lit(source.branch_id).alias("branch_id"),
            F.lit(source.branch_name).alias("branch_name"),
        )
        entries += [F.lit(key), labels]
    lookup = F.create_map(*entries)
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return F.coalesce(F.try_element_at(lookup, path), F.try_element_at(lookup, folder))


def with_labels(records: DataFrame, sources: Iterable[ReviewSource]) -> DataFrame:
    """Brand, branch and file name per record, from the source its file belongs to."""
    return (
        records.withColumn("_path", plain_path(F.col("path")))
        .withColumn("_labels", source_labels(sources, F.col("_path")))
        .select("raw", F.regexp_extract("_path", "[^/]*$", 0).alias("raw_source_file"), "_labels.*")
    )


def ingest(spark: SparkSession, sources: Iterable[ReviewSource], lines: bool = False) -> DataFrame:
    """All sources in one scan, labelled and normalized. The files are only read."""
    chosen = list(sources)
    reader = read_lines if lines else read_arrays
    return normalize(with_labels(reader(spark, [s.path for s in chosen]), chosen))
