"""Quality rules as a short-circuit cascade, in built-in functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import SPACE, cut, uniform

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Documents that costs and selectivities are estimated on, in expectation.
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """A reason to reject a document: a name and a condition over text, words and counts."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    """Rules that spare ordinary prose: each bounds a share that markup, tables and shouting exceed."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    # Without spaces a word joins the next one, and there are fewer places to replace.
    letters = F.length(F.regexp_replace(F.replace("text", F.lit(" "), F.lit("")), r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace("text", r"[^\p{Lu}]+", ""))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > F.col("n_words")),
        Rule("word_length", (F.col("word_chars") > 40 * F.col("n_words")) | (F.col("word_chars") * 2 < 3 * F.col("n_words"))),
        Rule("repeated_lines", F.col("n_dup_lines") * 10 > 3 * F.greatest(F.col("n_lines"), F.lit(1))),
        Rule("few_letters", letters * 10 < 6 * chars),
        Rule("capitals", capitals * 2 > chars),
    ]


def word_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Text, words, lines with a word and the hash of each five-word window."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # All white space becomes single blanks to split at, which needs no regular expression.
    blanks = F.col("text")
    for character in SPACE.replace(" ", ""):
        blanks = F.replace(blanks, F.lit(character), F.lit(" "))
    words = plain.withColumn("words", F.array_remove(F.split(blanks, " "), "")).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    hashed = words.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    # Hashes of 2, 4 and 5 words in a row; zip_with fills the longer side up with null, which is cut off.
    pair = lambda a, b, seed: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y, F.lit(seed)))
    hashed = hashed.withColumn("h2", pair(F.col("h1"), F.expr("slice(h1, 2, size(h1))"), 2))
    hashed = hashed.withColumn("h4", pair(F.col("h2"), F.expr("slice(h2, 3, size(h2))"), 4)).drop("h2")
    n = F.size("words")
    hashed = hashed.withColumn("h5", pair(F.col("h4"), F.expr("slice(h1, 5, size(h1))"), 5)).drop("h4", "h1")
    return hashed.withColumn(
        "windows", F.when(n >= WINDOW, F.slice("h5", F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    ).drop("h5")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where the optimizer copies the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(windows: str) -> Column:
    """Words inside a window that occurs at least twice; ``windows`` has the hash at each place.

    Only texts in which a hash repeats are sorted. Places with an equal neighbour in hash order
    are the repeated windows; in place order each covers up to the next one, five words at most.
    """

    def covered(ordered: Column) -> Column:
        # The last of a run of equal hashes is repeated too: the one before it is the same.
        same = lambda x, k: F.coalesce(x["h"] == F.get(ordered, k)["h"], F.lit(False))
        marked = F.filter(ordered, lambda x, k: same(x, k + 1) | same(x, k - 1))
        return F.aggregate(
            F.sort_array(F.transform(marked, lambda x: x["i"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, p: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n"), p.alias("last")
            ),
            lambda acc: acc["n"],
        )

    def counted(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, _bound(ordered, covered)).otherwise(F.lit(0)).cast("long")

    return _bound(F.col(windows), counted)


def symbols() -> Column:
    """Number of characters of ``SYMBOLS``, each of one byte."""
    without = F.col("text")
    for character in SYMBOLS:
        without = F.replace(without, F.lit(character), F.lit(""))
    return (F.octet_length("text") - F.octet_length(without)).cast("long")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every document and the base verdict, with text and words for the rules."""
    counted = word_columns(docs, id_col, text_col).select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        symbols().alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("windows").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return counted.withColumn("base_failed", failed)


def _seconds(df: DataFrame) -> float:
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def ordered_rules(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """Rules with their cost and rejected share on a stored sample, by rejection per cost.

    Only the order, and so the time, depends on measured costs; the verdict doesn't.
    """
    shares = sample.agg(*[F.avg(r.rejects.cast("double")).alias(r.name) for r in rules]).first()
    plain = _seconds(sample.select("doc_id"))
    found = []
    for rule in rules:
        cost = max(_seconds(sample.select(rule.rejects.alias("x"))) - plain, 1e-3)
        found.append((rule, cost, float(shares[rule.name] or 0.0)))
    return sorted(found, key=lambda x: (-x[2] / x[1], x[0].name))


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, or null; later rules aren't evaluated then."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, base verdict and the cascade's verdict for every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    and rejected_by ("base", a rule's name, or null for a kept document). Null text counts as
    empty and fails the base (fewer than ten words). Repeated rows are judged each by itself;
    ids may be null; an empty table gives no rows; other columns are not read.
    """
    rules = default_rules() if rules is None else rules
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = narrow.select("doc_id").count()
    drawn = cut(narrow.where(uniform("doc_id", "text", F.lit("quality")) < sample_rows / max(rows, 1)))
    sample = cut(base_counts(drawn).where("NOT base_failed"))
    order = [rule for rule, _, _ in ordered_rules(sample, rules)]
    counted = base_counts(narrow)
    by = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order))
    return counted.withColumn("rejected_by", by).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rejected_by").isNull().alias("kept"), "rejected_by",
    )
