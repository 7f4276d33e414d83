"""Rule-based routing of a table of questions."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import vocab
from reviewloom.functions.rows import unnest


def _mentions_any(lowered: Column, cues: Collection[str]) -> Column:
    found = F.lit(False)
    for cue in cues:
        found = found | F.contains(lowered, F.lit(cue))
    return found


def requested_period(question: Column) -> Column:
    """Month asked for as yyyy-MM: the numeric form first, then month names in calendar order.

    An optional "-" or "/" may separate year and month.
    """
    numeric = r"\b(20[0-9]{2})[-/]?(0?[1-9]|1[0-2])\b"
    found = [
        F.when(
            question.rlike(numeric),
            F.concat_ws(
                "-",
                F.regexp_extract(question, numeric, 1),
                F.lpad(F.regexp_extract(question, numeric, 2), 2, "0"),
            ),
        )
    ]
    lowered = F.lower(question)
    for number, name in enumerate(vocab.MONTH_NAMES, start=1):
        named = rf"\b{name}\s+(20[0-9]{{2}})\b"
        year = F.regexp_extract(lowered, named, 1)
        found.append(F.when(year != "", F.concat(year, F.lit(f"-{number:02d}"))))
    return F.coalesce(*found)


def mentioned_branches(questions: DataFrame, branches: DataFrame, key: str = "question_id") -> DataFrame:
    """(question, branch) pairs where the question contains the branch name or its id in words.

    A substring join by equality. Every question is cut into its distinct substrings, of
    the few lengths that branch spellings have, and those are joined with the spellings.
    Only true mentions meet, however many branches share a beginning, and the rows grow
    with the questions' length and not with the number of branches.
    """
    names = F.array(F.lower("branch_name"), F.replace(F.col("branch_id"), F.lit("_"), F.lit(" ")))
    spelled = unnest(branches, F.array_distinct(names), "spelling", "branch_id").where(
        F.length("spelling") > 0
    )
    lengths = spelled.agg(F.collect_set(F.length("spelling"))).scalar()
    lowered = questions.select(key, F.lower("question").alias("lowered")).withColumn("lengths", lengths)
    text, size = F.col("lowered"), F.length("lowered")

    def substrings(width):
        return F.transform(F.sequence(F.lit(1), size - width + 1), lambda i: F.substring(text, i, width))

    fitting = F.filter("lengths", lambda width: width <= size)
    parts = F.array_distinct(F.flatten(F.transform(fitting, substrings)))
    return unnest(lowered, parts, "spelling", key).join(spelled, "spelling").select(key, "branch_id").distinct()


def route_questions(questions: DataFrame, branches: DataFrame, key: str = "question_id") -> DataFrame:
    """One row per question: branches, scope, period and whether it asks for advice.

    Two mentioned branches, or a comparison word, select every known branch.
    """
    # A question holds only so many spellings, so this list is bounded by its length.
    named = (
        mentioned_branches(questions, branches, key)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("branch_id")).alias("named"))
    )
    lowered = F.lower("question")
    everyone = branches.agg(F.array_sort(F.collect_set("branch_id"))).scalar()
    found = F.coalesce("named", F.array().cast("array<string>"))
    compares = (F.size(found) > 1) | _mentions_any(lowered, vocab.COMPARISON_CUES)
    return (
        questions.join(named, key, "left")
        .withColumn("compares", compares)
        .withColumn("branch_ids", F.when(F.col("compares"), everyone).otherwise(found))
        .select(
            key,
            "question",
            "branch_ids",
            F.when(F.size("branch_ids") == 1, F.col("branch_ids")[0]).alias("branch_id"),
            F.when(F.size("branch_ids") > 1, "comparison")
            .when(F.size("branch_ids") == 1, "branch")
            .otherwise("brand")
            .alias("scope"),
            requested_period(F.col("question")).alias("period"),
            _mentions_any(lowered, vocab.RECOMMENDATION_CUES).alias("wants_recommendations"),
        )
    )
