"""Language ID: script ranges narrow the candidates, Viterbi over word scores labels spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import by_place, id_and_text, remainder, text_slices, uniform

#: Labelled documents per language that the scores are learned from, in expectation.
TRAIN_DOCS = 3_000
BUCKETS = 1 << 16
#: Text bytes that are labelled together; a longer text is a slice of its own and takes about 40 bytes of memory a byte.
SLICE_TEXT = 2 << 20
#: What a change of language between two words costs, in nats.
SWITCH = 12.0
#: Nats by which a word's language must lead all others for the word to count as recognised.
CLEAR = 2.0
UNKNOWN = "und"
# First code points of Unicode script blocks; what lies between has the number before it.
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Indic"), (0x0E00, "Thai"), (0x0E80, "Other Asian"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"), (0xF900, "Han"), (0xFB50, "Arabic"),
    (0xFF21, "Latin"), (0xFF66, "Kana"), (0x10000, "Other"), (0x20000, "Han"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@dataclass
class Model:
    """Log scores of hashed letter n-grams, and which languages each script may hold."""

    langs: list[str]
    scores: np.ndarray  # float32[BUCKETS, languages]
    allowed: np.ndarray  # bool[scripts, languages]


def script_of(codes: np.ndarray) -> np.ndarray:
    """Script number of each code point."""
    starts = np.array([s for s, _ in SCRIPTS])
    names = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], np.int8)
    return names[np.maximum(np.searchsorted(starts, codes, "right") - 1, 0)]


def letter_table() -> np.ndarray:
    """Whether each code point of the first three planes is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)


@dataclass
class Words:
    """The words (runs of letters) of some texts."""

    codes: np.ndarray  # code points, lower case; what is no letter is a blank
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray
    text_start: np.ndarray


def words_of(texts: list[str], letters: np.ndarray) -> Words:
    """Find the words of each text; a text never runs into the next one."""
    lower = [t.lower() for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lower])])
    codes = np.frombuffer((" ".join(lower) + " ").encode("utf-32-le"), np.uint32).copy()
    is_letter = letters[np.minimum(codes, len(letters) - 1)]
    for far in np.flatnonzero(codes >= len(letters)):
        is_letter[far] = chr(codes[far]).isalpha()
    codes[~is_letter] = 32
    edge = np.diff(np.concatenate([[False], is_letter, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return Words(codes, start, end - start, np.searchsorted(begin, start, "right") - 1, begin)


def gram_buckets(codes: np.ndarray, upto: int = 4) -> list[np.ndarray]:
    """Hash buckets of the 2-, 3- and 4-grams that end at each place."""
    x = codes.astype(np.uint32)
    found, h = [], x * np.uint32(0x9E3779B1)
    for n in range(2, upto + 1):
        before = np.concatenate([np.full(n - 1, 32, np.uint32), x[: len(x) - n + 1]])[: len(x)]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + before * np.uint32(0xC2B2AE35) + np.uint32(n)
        found.append((h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> np.uint32(16))
    return found


def _places(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of each word's letters and of the blank after it, and where each word's begin."""
    count = words.length + 1
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    return np.repeat(words.start - first, count) + np.arange(int(count.sum())), first


def gram_counts(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of n-gram buckets and of letters by script."""
    words = words_of(texts, letters)
    grams, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
    if len(words.start):
        places, _ = _places(words)
        for buckets in gram_buckets(words.codes):
            grams += np.bincount(buckets[places], minlength=BUCKETS)
        np.add.at(scripts, script_of(words.codes[words.start]), words.length)
    return grams, scripts


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_DOCS) -> Model:
    """Learn from labelled documents, of each language about ``per_language`` chosen by hash of id and text.

    Rows without a text or language teach nothing. The draw depends on values alone, so equal rows
    are all drawn or none. A language none of whose rows is drawn isn't learned; if no language
    is, the model is empty. Null ids and repeated ids are like others.
    """
    frame, (doc_id, text, lang) = by_place(docs, id_col, text_col, lang_col)
    named = frame.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    labelled = named.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    empty = Model([], np.zeros((BUCKETS, 0), np.float32), np.ones((len(SCRIPT_NAMES), 0), bool))
    if not counts:
        return empty
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, per_language / n)]), F.col("lang"))
    drawn = labelled.where(uniform("doc_id", "text", F.lit("language")) < rate)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, kept = letter_table(), {}
        for batch in batches:
            for part in text_slices(batch, "text"):
                names, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
                for lang in set(names):
                    grams, scripts = gram_counts([t for t, n in zip(texts, names, strict=True) if n == lang], letters)
                    one = np.concatenate([grams, scripts])
                    kept[lang] = kept[lang] + one if lang in kept else one
        for lang, values in kept.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(values[at], pa.int64())], ["lang", "slot", "n"])

    # At most (buckets + scripts) rows per language come to the driver.
    found = drawn.mapInArrow(partial, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(found["lang"]))
    if not langs:
        return empty
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    table[found["slot"].to_numpy(), [langs.index(x) for x in found["lang"]]] = found["n"].to_numpy()
    grams, scripts = table[:BUCKETS] + 0.5, table[BUCKETS:]
    scores = np.log(grams / grams.sum(0))
    scores -= scores.mean(1, keepdims=True)
    allowed = scripts >= 0.01 * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script that no language uses rules none out
    return Model(langs, scores.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, doc_start: np.ndarray, doc_words: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word, where each change of language between words costs ``switch``.

    Texts take their steps together, the longest first, so a step is one operation on all texts
    that still have a word.
    """
    labels = np.zeros(len(scores), np.int16)
    order = np.argsort(-doc_words, kind="stable")
    order = order[doc_words[order] > 0]
    if not len(order):
        return labels
    start, count = doc_start[order], doc_words[order]
    steps = int(count[0])
    active = np.searchsorted(-count, -np.arange(steps), "left")
    back = np.empty(scores.shape, np.int8 if scores.shape[1] < 128 else np.int16)
    own, best_so_far = np.arange(scores.shape[1], dtype=back.dtype)[None, :], scores[start].astype(np.float64)
    rows = np.arange(len(start))
    for step in range(1, steps):
        m = active[step]
        now = best_so_far[:m]
        best = now.argmax(1)
        changed = now[rows[:m], best][:, None] - switch
        at, stay = start[:m] + step, now >= changed
        back[at] = np.where(stay, own, best[:, None])
        best_so_far[:m] = np.where(stay, now, changed) + scores[at]
    state = best_so_far.argmax(1)
    for step in range(steps - 1, -1, -1):
        m = active[step]
        at = start[:m] + step
        labels[at] = state[:m]
        if step:
            state[:m] = back[at, state[:m]]
    return labels


def word_scores(texts: list[str], model: Model, letters: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of the texts and the scores of all languages for each."""
    words, parts = words_of(texts, letters), []
    if not len(words.start) or not model.langs:
        return words, np.zeros((len(words.start), len(model.langs)), np.float32)
    # n-grams in blocks of words, so that the looked-up rows stay small.
    buckets = gram_buckets(words.codes)
    for block in range(0, len(words.start), 40_000):
        some = Words(words.codes, words.start[block : block + 40_000], words.length[block : block + 40_000], words.doc, words.text_start)
        places, first = _places(some)
        total = sum(model.scores[b[places]] for b in buckets)
        parts.append(np.add.reduceat(total, first, axis=0))
    scores = np.concatenate(parts) / len(buckets)
    scores[~model.allowed[script_of(words.codes[words.start])]] -= 50.0
    return words, scores


def _best_labels(n_texts: int, words: Words, scores: np.ndarray, switch: float) -> np.ndarray:
    if not scores.size:
        return np.zeros(len(words.start), np.int16)
    per_doc = np.bincount(words.doc, minlength=n_texts)
    return viterbi(scores, np.concatenate([[0], np.cumsum(per_doc)[:-1]]), per_doc, switch)


def label_texts(texts: list[str], model: Model, letters: np.ndarray, switch: float = SWITCH):
    """Words of the texts and the language number of each."""
    words, scores = word_scores(texts, model, letters)
    return words, _best_labels(len(texts), words, scores, switch)


def spans_of(words: Words, labels: np.ndarray, n_docs: int):
    """Runs of words of one language: document, language, start and end in its lower-case text."""
    if not len(labels):
        return (np.zeros(0, np.int64),) * 4
    new = np.flatnonzero(np.concatenate([[True], (np.diff(labels) != 0) | (np.diff(words.doc) != 0)]))
    last = np.concatenate([new[1:], [len(labels)]]) - 1
    shift = words.text_start[words.doc[new]]
    return words.doc[new], labels[new], words.start[new] - shift, words.start[last] + words.length[last] - shift


def _predicted(texts: list[str | None], model: Model, letters: np.ndarray, switch: float):
    """Words and labels, and each text's main language, whether it is unknown, and its share of the letters."""
    texts, n = [t or "" for t in texts], max(len(model.langs), 1)
    words, labels = label_texts(texts, model, letters, switch)
    share = np.bincount(words.doc * n + labels, weights=words.length, minlength=len(texts) * n).reshape(-1, n)
    total = share.sum(1)
    unknown = (total == 0) | (not model.langs)
    return words, labels, share.argmax(1), unknown, np.where(unknown, 0.0, share.max(1) / np.maximum(total, 1))


def _recognised(texts: list[str | None], model: Model, letters: np.ndarray, switch: float) -> np.ndarray:
    """Share of each text's letters in words whose label leads clearly; NaN for a text without letters."""
    texts = [t or "" for t in texts]
    words, scores = word_scores(texts, model, letters)
    clear, own = np.ones(len(words.start), bool), np.arange(len(words.start))
    if len(model.langs) > 1 and len(own):
        labels = _best_labels(len(texts), words, scores, switch)
        mine = scores[own, labels]
        scores[own, labels] = -np.inf
        clear = mine - scores.max(1) >= CLEAR
    total = np.bincount(words.doc, weights=words.length, minlength=len(texts))
    sure = np.bincount(words.doc, weights=words.length * clear, minlength=len(texts))
    return np.where(total > 0, sure / np.maximum(total, 1), np.nan)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """Language and language spans of every document, from its text alone.

    Returns doc_id, lang_pred, score and spans (start and end in code points of the lower-case
    text, and the language). The prediction is the language with most letters; the score is its
    share of the letters. A text that is null or has no letter, or any text if nothing could be
    learned, is "und" with score 0 and no spans. Ties go to the language first in code point
    order; repeated rows are labelled each by itself; an empty table gives no rows.
    """
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = shared.value, letter_table()
        names = pa.array([*model.langs, UNKNOWN])
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_TEXT):
                texts = part.column("text").to_pylist()
                words, labels, best, unknown, score = _predicted(texts, model, letters, switch)
                best[unknown] = len(model.langs)
                doc, lang, start, end = spans_of(words, labels, len(texts)) if model.langs else (np.zeros(0, int),) * 4
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
                values = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), names.take(pa.array(lang, pa.int32()))], fields=list(span))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), names.take(pa.array(best, pa.int32())), pa.array(score), lists], ["doc_id", "lang_pred", "score", "spans"])

    narrow = id_and_text(docs, id_col, text_col)
    return narrow.mapInArrow(label, "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def train_part(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents that may be learned from: all but every fourth by crc32 of the id."""
    return docs.where(remainder(id_col, 4) != 2)


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.4, text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """Documents with recognised languages, however many, in at least ``least_score`` of their letters, with all columns.

    A word is recognised if its label leads all other languages by ``CLEAR`` nats; the words of all
    spans count. If nothing or only one language could be learned there is nothing to compare
    with, and every document with a letter stays. Labels that are one language under two names
    don't lead each other, so their words aren't recognised. A text that is null or has no letter
    goes; repeated rows and null ids stay or go by their text alone; an empty table gives no rows;
    other columns may have any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    frame, (text_col,) = by_place(docs, text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = shared.value, letter_table()
        for batch in batches:
            for part in text_slices(batch, text_col, SLICE_TEXT):
                share = _recognised(part.column(text_col).to_pylist(), model, letters, switch)
                yield part.filter(pa.array(share >= least_score))

    return frame.mapInArrow(keep, frame.schema).toDF(*docs.columns)
