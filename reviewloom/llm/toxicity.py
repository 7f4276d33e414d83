"""Toxicity: boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import cut, raw_text, remainder, text_slices, uniform

#: Labelled documents that lexicon, trees and calibration are learned from, in expectation.
TRAIN_DOCS = 16_000
LEXICON_WORDS = 100
#: Lengths of word beginnings that may enter the lexicon.
PREFIX = (4, 8)
#: Characters between a lexicon word and a second-person word that count as near.
NEAR = 30
# Second-person words of the languages in scope.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine euch ihr tu te toi ton ta vous votre tú ti tus usted vosotros".split()
)
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|+", "oleastasiit")
FEATURES = (
    "lexicon_density", "lexicon_hits", "lexicon_distinct", "lexicon_weight", "obfuscated_hits", "near_second_person",
    "second_person_density", "capital_rate", "exclamation_rate", "question_rate", "symbol_rate", "digit_rate",
    "capital_words", "obfuscated_rate", "log_words",
)
_INNER = re.compile(r"(?<=[a-z])[.*_\-](?=[a-z])")
_CAPITAL_WORD = re.compile(r"\b[A-Z]{3,}\b")
_MIXED_WORD = re.compile(r"[A-Za-z][0-9@$!|*]+[A-Za-z]")


def learn_lexicon(labelled: DataFrame, most: int = LEXICON_WORDS, least_gain: float = 25.0) -> list[tuple[str, float]]:
    """Word beginnings that mark toxic documents, with their log odds; ``labelled`` has text and toxic.

    Beginnings of four to eight letters count once per document, so that inflected and compound
    words are found too. One is kept if its log-likelihood ratio against an equal spread is
    ``least_gain`` or more (five standard errors) and it neither begins nor continues a better one.
    """
    totals = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    low, high = PREFIX
    words = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")), lambda w: F.length(w) >= low)
    starts = F.transform(words, lambda w: F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length(w))), lambda n: F.substr(w, F.lit(1), n)))
    counts = (
        labelled.select("toxic", F.explode(F.array_distinct(F.flatten(starts))).alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
        .where("a >= 5")
    )
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    odds = F.log(a / F.lit(toxic + 1.0)) - F.log(b / F.lit(clean + 1.0))
    share = toxic / max(toxic + clean, 1)
    gain = F.expr(f"2 * (a * ln(a / (n * {share})) + if(n > a, (n - a) * ln((n - a) / (n * {1 - share})), 0))")
    found = (
        counts.select("word", odds.alias("weight"), gain.alias("gain"))
        .where((F.col("gain") >= least_gain) & (F.col("weight") >= 1.0))
        .orderBy(F.desc("gain"), F.desc(F.length("word")), "word")
        .limit(20 * most)
    )
    kept: list[tuple[str, float]] = []
    for r in found.collect():
        if len(kept) < most and not any(r.word.startswith(w) or w.startswith(r.word) for w, _ in kept):
            kept.append((r.word, float(r.weight)))
    return kept


def matcher(lexicon: list[tuple[str, float]]):
    """Finds lexicon entries (with their number) and second-person words (-1)."""
    automaton = ahocorasick.Automaton()
    for word in SECOND_PERSON:
        automaton.add_word(word, (-1, len(word)))
    for i, (word, _) in enumerate(lexicon):
        automaton.add_word(word, (i, len(word)))
    automaton.make_automaton()
    return automaton


def hits(automaton, text: str) -> list[tuple[int, int]]:
    """(position, number) of every word that begins with a lexicon entry or is a second-person word."""
    found, n = [], len(text)
    for end, (i, length) in automaton.iter(text):
        start = end - length + 1
        if (start == 0 or not text[start - 1].isalnum()) and (i >= 0 or end + 1 == n or not text[end + 1].isalnum()):
            found.append((start, i))
    return found


def _byte_rates(values) -> list[np.ndarray]:
    """Counts per text of white space, A-Z, !, ?, symbols and digits."""
    data, offsets = raw_text(values)
    groups = (b" \t\n\x0b\f\r", bytes(range(65, 91)), b"!", b"?", b"#*$%&|<>@~^_=+", b"0123456789")
    counts = []
    for group in groups:
        flags = np.zeros(256, np.int32)
        flags[list(group)] = 1
        sums = np.concatenate([[0], np.cumsum(flags[data], dtype=np.int64)])
        counts.append(np.diff(sums[offsets]))
    return [*counts, np.diff(offsets)]


def features(docs: DataFrame, lexicon: list[tuple[str, float]], keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The dense features of each text, as an array in the order of FEATURES."""
    kinds = dict(docs.dtypes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, weights = matcher(lexicon), np.array([w for _, w in lexicon])
        for batch in batches:
            for part in text_slices(batch, "text"):
                spaces, capitals, bangs, questions, symbols, digits, size = _byte_rates(part.column("text"))
                words, letters = spaces + 1.0, np.maximum(size - spaces, 1.0)
                rows = np.zeros((part.num_rows, len(FEATURES)))
                for k, text in enumerate(part.column("text").to_pylist()):
                    if not text:
                        continue
                    lower = text.lower()
                    found = hits(automaton, lower)
                    near_to = [p for p, i in found if i < 0]
                    own = [(p, i) for p, i in found if i >= 0]
                    plain = lower.translate(DISGUISE)
                    plain = _INNER.sub("", plain)
                    hidden = max(sum(i >= 0 for _, i in hits(automaton, plain)) - len(own), 0) if plain != lower else 0
                    at, close = np.array(near_to), 0
                    if own and near_to:
                        p = np.array([p for p, _ in own])
                        right = np.searchsorted(at, p)
                        gap = np.minimum(np.abs(at[np.minimum(right, len(at) - 1)] - p), np.abs(at[np.maximum(right - 1, 0)] - p))
                        close = int((gap <= NEAR).sum())
                    rows[k, :7] = (
                        (len(own) + hidden) / words[k], np.log1p(len(own)), len({i for _, i in own}),
                        float(weights[[i for _, i in own]].sum()) if own else 0.0, np.log1p(hidden), close, len(near_to) / words[k],
                    )
                    rows[k, 12] = len(_CAPITAL_WORD.findall(text)) / words[k] if capitals[k] > 2 else 0.0
                    rows[k, 13] = len(_MIXED_WORD.findall(text)) / words[k] if digits[k] + symbols[k] + bangs[k] else 0.0
                for column, values in zip(range(7, 12), (capitals, bangs, questions, symbols, digits), strict=True):
                    rows[:, column] = values / letters
                rows[:, 14] = np.log1p(words)
                offsets = np.arange(part.num_rows + 1, dtype=np.int32) * len(FEATURES)
                arrays = [part.column("doc_id"), *[part.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *keep, "x"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep)
    return narrow.mapInArrow(measure, "doc_id long, " + "".join(f"{c} {kinds[c]}, " for c in keep) + "x array<double>")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Chance that each text is toxic, learned from labelled documents.

    ``labels`` has the ids to learn from and 0 or 1. About ``train_docs`` of them, chosen by hash
    of the id, are used: three quarters for the lexicon and the trees, one quarter for the
    calibration. Returns doc_id, score and predicted (score >= 0.5). Null and empty texts have
    all-zero rates and get a score like any other; without labels of both kinds every score is
    the share of toxic labels, or 0. An id labelled twice counts once, toxic if any label is;
    rows repeated in ``docs`` are scored each by itself.
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    )
    rate = train_docs / max(known.count(), 1)
    drawn = known.where(uniform("doc_id", F.lit("toxicity")) < rate)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = cut(texts.join(drawn, "doc_id").dropDuplicates(["doc_id"]))
    fit = uniform("doc_id", F.lit("calibrate")) < 0.75
    kinds = {r.toxic: (r.n, r.m) for r in sample.groupBy("toxic").agg(F.count("*").alias("n"), F.count_if(fit).alias("m")).collect()}
    if len(kinds) < 2 or min(m for _, m in kinds.values()) < 2 or min(n - m for n, m in kinds.values()) < 1:
        share = kinds.get(1, (0, 0))[0] / max(sum(n for n, _ in kinds.values()), 1)
        constant = texts.select("doc_id", F.lit(float(share)).alias("score"))
        return constant.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    lexicon = learn_lexicon(sample.where(fit))
    rows = cut(
        features(sample, lexicon, ("toxic",))
        .select("doc_id", F.col("toxic").cast("double").alias("label"), array_to_vector("x").alias("features"))
        .coalesce(8)
    )
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=7, maxBins=32).fit(rows.where(fit))
    chance = vector_to_array("probability")[1]
    held = trees.transform(rows.where(~fit)).select("label", chance.alias("chance"))
    steps = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="calibrated").fit(held)
    every = features(texts, lexicon).select("doc_id", array_to_vector("x").alias("features"))
    scored = steps.transform(trees.transform(every).select("doc_id", chance.alias("chance")))
    # A thousandth of the trees' own chance keeps their order within a calibrated step.
    mixed = F.least(F.greatest(F.col("calibrated") * 0.999 + F.col("chance") * 0.001, F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", mixed.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train_part(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labels that may be learned from: all but every fifth by crc32 of the id."""
    return labels.where(remainder(id_col, 5) != 0)
