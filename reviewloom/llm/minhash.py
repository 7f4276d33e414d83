"""MinHash near-duplicates by min-max hashing: minimum and maximum under each permutation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import by_place, id_and_text, mixed, raw_text, text_slices, written
from reviewloom.llm.components import components

#: Permutations of the estimate; each gives a minimum and a maximum. The first of them give the
#: bands: 32 bands of 6 values find a pair of similarity 0.85 with a chance of 1 - 3e-7.
PERMUTATIONS, BANDS, ROWS = 384, 32, 6
#: Members of a bucket that are compared in one go.
BLOCK = 2048
#: Standard errors that an estimate may lie under the least similarity before a pair is passed over
#: (a pair above it is missed with a chance below 2e-7, less than bands miss).
ERRORS = 5.2
#: Smallest shingle hashes (of 24 bits) that the finer estimate has of each set; a set of no more
#: shingles is compared as a whole. The slack covers chance agreement of hashes.
SKETCH, SLACK = 256, 0.01
SHINGLE = 3
NO_ID = -(1 << 63)
_RNG = np.random.default_rng(77)
_A = _RNG.integers(0, 1 << 31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32)
_WEIGHTS = _RNG.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RNG.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x5851F42D4C957F2D)
#: Words are hashed as polynomials modulo two primes (a power of two would let self-similar words collide).
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (1_277_093_419, 904_318_277)
_LOWER = np.arange(256, dtype=np.int64) + 1
_LOWER[65:91] += 32
#: Text bytes whose words are hashed together, and powers that are kept for the next ones.
_KEPT_POWERS = 1 << 20
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base modulo a prime below 2^31."""
    known = _POWERS.get(base, np.ones(1, np.uint32))
    while len(known) < n:
        step = pow(base, len(known), prime)
        known = np.concatenate([known, (known[: n - len(known)] * np.int64(step) % prime).astype(np.uint32)])
    if len(known) <= 2 * _KEPT_POWERS:
        _POWERS[base] = known
    return known[:n]


def _polynomials(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, prime: int) -> np.ndarray:
    """The polynomial of each span of some values modulo a prime, by prefix sums."""
    sums = np.zeros(len(values) + 1, np.int64)
    terms = values * _powers(base, prime, len(values))
    if len(terms) > 1 << 23:  # terms are below 2^40, so the sum of up to 2^23 fits
        terms %= prime
    np.cumsum(terms, out=sums[1:])
    down = _powers(pow(base, -1, prime), prime, len(values))
    return (sums[ends] - sums[starts]) % prime * down[starts] % prime


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word with A-Z in lower case, and the number of words of each text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = ~_BLANK[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(word & (first[:-1] | np.concatenate([[True], ~word[:-1]])))
    ends = np.flatnonzero(word & (first[1:] | np.concatenate([~word[1:], [True]]))) + 1
    values, found = _LOWER[data], np.zeros((2, len(starts)), np.int64)
    # A very long text goes in blocks of words; a word longer than a block is a block of its own.
    edges = [0, *(np.flatnonzero(np.diff(ends // _KEPT_POWERS)) + 1).tolist(), len(starts)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            low, high = int(starts[a]), int(ends[b - 1])
            for k in range(2):
                found[k, a:b] = _polynomials(values[low:high], starts[a:b] - low, ends[a:b] - low, BASES[k], PRIMES[k])
    hashes = mixed(found[0].astype(np.uint64) << np.uint64(32) | found[1].astype(np.uint64)) ^ mixed((ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(values: pa.StringArray, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``width`` (up to 8) words."""
    words, counts = word_hashes(*raw_text(values))
    ends = np.cumsum(counts)
    if len(words) >= width:
        places = len(words) - width + 1
        shingles = words[:places] * _MIX[0]
        for k in range(1, width):
            shingles += words[k : k + places] * _MIX[k]
        shingles = mixed(shingles)
    sets = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= width:
            sets.append(np.unique(shingles[end - n : end - width + 1]))
        else:
            whole = words[end - n : end]
            sets.append(mixed((whole * _MIX[8 : 8 + n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)) if n else whole)
    return sets


def signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """Band keys of a non-empty set, and four bits of its minimum and maximum under each permutation."""
    low, high = None, None
    for at in range(0, len(shingles), 4096):
        x = (shingles[at : at + 4096] >> np.uint64(32)).astype(np.uint32)
        values = _A[:, None] * x[None, :] + _B[:, None]
        a, b = values.min(1), values.max(1)
        low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
    both = np.stack([low, high], 1).ravel() * np.uint32(0x9E3779B1)  # a permutation's two values are neighbours
    parts = both[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    bands = mixed((parts * _WEIGHTS).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    bits = (both >> np.uint32(28)).astype(np.uint8)
    return bands.tobytes(), (bits[0::2] << 4 | bits[1::2]).tobytes()


def estimates(signatures: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Estimated similarity of each signature to one; four bits agree by chance once in sixteen."""
    differ = signatures ^ one
    equal = ((differ & 0xF0) == 0).mean(1) / 2 + ((differ & 0x0F) == 0).mean(1) / 2
    return (16 * equal - 1) / 15


def least_estimate(share: float, values: int) -> float:
    """Estimate from so many values below which a similarity of ``share`` is all but excluded."""
    return share - ERRORS * (share * (1 - share) / values) ** 0.5


def sketch(shingles: np.ndarray) -> bytes:
    """The smallest distinct 24-bit hashes of a set."""
    return np.unique((shingles >> np.uint64(20)).astype(np.uint32) & np.uint32(0xFFFFFF))[:SKETCH].view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def read_sketch(data: bytes) -> np.ndarray:
    """The hashes of a sketch, in order."""
    parts = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
    return parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16


def sketch_excess(one: np.ndarray, others: list[np.ndarray], share: float) -> np.ndarray:
    """Estimated similarity of each sketch to one, less what a similarity of ``share`` is sure to reach.

    Below the smaller end of two sketches both show their sets whole, which is a fair sample of
    the union; where no sketch is cut off it is the union itself, without an error.
    """
    sizes = np.array([len(x) for x in others])
    flat, starts = np.concatenate(others), np.cumsum(sizes) - sizes
    top = np.iinfo(np.int32).max
    ends = np.where(sizes < SKETCH, top, flat[starts + sizes - 1])
    ends = np.minimum(ends, top if len(one) < SKETCH else one[-1])
    within = flat <= np.repeat(ends, sizes)
    both = within & (one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat)
    shared, theirs = np.add.reduceat(both, starts), np.add.reduceat(within, starts)
    union = np.searchsorted(one, ends, "right") + theirs - shared
    error = np.where(ends == top, 0.0, np.sqrt(share * (1 - share) / union))
    return shared / union - (share - SLACK - ERRORS * error)


def _sets(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                sets = shingle_sets(part.column("text"), width)
                signatures = [signature(s) if len(s) else (None, None) for s in sets]
                keys = [int(mixed(s).sum(dtype=np.uint64)).to_bytes(8, "little") + int(mixed(s ^ _BASE).sum(dtype=np.uint64)).to_bytes(8, "little") for s in sets]
                arrays = [
                    part.column("doc_id"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()), *[pa.array(v, pa.binary()) for v in zip(*signatures, strict=True)],
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "n_shingles", "set_key", "bands", "signature"])

    return read


def _sketches(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                sketches = [sketch(s) for s in shingle_sets(part.column("text"), width)]
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array(sketches, pa.binary())], ["cls", "sketch"])

    return read


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bands = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            cls = np.repeat(np.asarray(batch.column("cls")), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(cls)], ["band", "cls"])


def _linked(percent: int, width: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in text_slices(batch, "text_a", 2 << 20):
                for part in text_slices(half, "text_b", 2 << 20):
                    ours, at = part.column("text_a").dictionary_encode(), []
                    sets = shingle_sets(ours.dictionary, width)
                    for k, theirs in zip(np.asarray(ours.indices).tolist(), shingle_sets(part.column("text_b"), width), strict=True):
                        shared = len(np.intersect1d(sets[k], theirs, assume_unique=True))
                        at.append(100 * shared >= percent * (len(sets[k]) + len(theirs) - shared))
                    yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(at, pa.bool_()))

    return confirm


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough; ``texts`` has cls and text."""
    with_b = pairs.join(texts.toDF("b", "text_b"), "b")
    return with_b.join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(_linked(percent, width), "a long, b long").distinct()


def _texts_of(members: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """cls and text of the classes that share a bucket, written once for all comparisons."""
    wanted = members.select("cls").distinct().join(classes.select("cls", F.col("rep_id").alias("doc_id"), F.col("rep_key").alias("text_key")), "cls")
    # Repeated rows would give a class its text as often, and a pair of classes the product of both.
    once = texts.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    return written(wanted.join(once, ["doc_id", "text_key"]).select("cls", "text"), "texts")


def _close_pairs(step: str, share: float):
    """Pairs of different components within each (band, i, j) that may be similar; input is sorted by it.

    Step "pivots" takes only pairs with one row: the one nearest to the most frequent values,
    which is likely the text that the others are copies of. Step "nearest" takes, for each row
    outside the largest component, the pair with the largest estimate. Step "rest" takes all.
    """
    least = least_estimate(share, 2 * PERMUTATIONS)

    def compare(rows: list[tuple]) -> set[tuple[int, int]]:
        cls, comp, own = (np.array([r[k] for r in rows]) for k in (0, 1, 3))
        signs = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
        found, some = set(), range(len(rows))
        if step == "pivots":
            ordered = np.sort(signs, 0)
            usual = ordered[len(rows) // 2]  # a value that half of the rows have is the median
            some = [int((signs == usual).mean(1).argmax())]
        else:
            sketches = [read_sketch(r[4]) for r in rows]
            names, counts = np.unique(comp, return_counts=True)
            some = np.flatnonzero(comp != names[counts.argmax()]).tolist()  # a pair across components has one of these
        for k in some:
            ok = comp != comp[k]
            if step != "pivots" and rows[k][5] != rows[k][6]:  # two blocks: only pairs across them
                ok &= own != own[k]
            at = np.flatnonzero(ok)
            if len(at):
                at = at[estimates(signs[at], signs[k]) >= least]
            if len(at) and step != "pivots":
                excess = sketch_excess(sketches[k], [sketches[x] for x in at.tolist()], share)
                at = at[excess >= 0] if step == "rest" else at[excess == excess.max()][:1] if excess.max() >= 0 else at[:0]
            found.update((min(int(cls[k]), int(cls[x])), max(int(cls[k]), int(cls[x]))) for x in at)
        return found

    def table_of(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            out: set[tuple[int, int]] = set()
            for r in zip(*(batch.column(c).to_pylist() for c in ("band", "i", "j", "cls", "comp", "signature", "block", "sketch")), strict=True):
                if r[:3] != key:
                    out |= compare(rows) if len(rows) > 1 else set()
                    key, rows = r[:3], []
                rows.append((*r[3:], r[1], r[2]))
            yield table_of(out)
        yield table_of(compare(rows) if len(rows) > 1 else set())

    return walk


def _still_open(members: DataFrame) -> DataFrame:
    """Buckets that still hold several components, with their number of blocks."""
    stats = members.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n"))
    return stats.where("low < high AND n > 2").select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))


def _divided(members: DataFrame, signs: DataFrame) -> DataFrame:
    """Buckets that still hold several components, in blocks; each pair of blocks is a group."""
    rows = members.join(_still_open(members), "band").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "comp", "block"
    ).join(signs, "cls")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """Components of documents whose sets of shingles (of ``width`` words) are similar.

    Two documents are linked if ``100 * intersection >= percent * union``. Returns doc_id,
    n_shingles, component_id (smallest doc_id of the component) and kept (is it that one).

    Documents with equal sets are one class from the start, so copies meet nothing twice. Classes
    that share a band are candidates: in each bucket all are compared with the smallest, which
    joins most; in buckets with several components left, all are compared with the one most like
    the others; what is still apart is compared in blocks by signature and by a sketch of the set,
    first to link each row with its nearest, then for all pairs left, and every pair that may be
    similar is confirmed on full sets. The bands are made for a ``percent`` of 80 or more. So no bucket is capped, and a
    link within a component is the only thing not looked for. Texts without a word, and null
    texts, have no shingles and are linked with nothing. Null ids come last in a component.
    Repeated rows fall into one class. An empty table gives no rows.
    """
    found = grouped(docs, percent, id_col, text_col, width)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_per_group(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """The documents without near duplicates: of each component one row with the smallest id, with all columns.

    Components are told apart by their links, not by ids: unrelated texts with null ids, or with
    one id, all stay. Documents without a word stay, each id and text once. Other columns may have
    any name; an empty table gives no rows.
    """
    names = docs.columns
    docs, (id_col, text_col) = by_place(docs, id_col, text_col)
    found = grouped(docs, percent, id_col, text_col, width)
    alone = [F.when(F.col("component").isNull(), F.col(c)) for c in ("doc_id", "text_key")]
    first = F.row_number().over(Window.partitionBy("component", *alone).orderBy(F.asc_nulls_last("doc_id"), "text_key"))
    chosen = found.withColumn("n", first).where("n = 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_key"))
    met = rows.join(chosen.withColumn("_id", F.coalesce("_id", F.lit(NO_ID))), ["_id", "_key"])
    # Repeated rows share id and text: the first stays.
    once = met.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_id"))).where("_n = 1")
    return once.select("_row.*").toDF(*names)


def grouped(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and component of every document; see near_duplicates.

    ``component`` is a number of the component itself, null for a document without a word. Several
    components may have one component_id: a null one, or that of an id with several texts.
    """
    texts = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    stored = written(texts.mapInArrow(_sets(width), "doc_id long, text_key long, n_shingles long, set_key binary, bands binary, signature binary"), "sets")
    # Of equal sets the document with the smallest id stands for all.
    first = F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order"), F.col("doc_id").alias("id"), F.col("text_key").alias("key")))
    classes = written(
        stored.where("n_shingles > 0").groupBy("set_key").agg(first.alias("rep"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
        .select(F.monotonically_increasing_id().alias("cls"), "set_key", F.coalesce("rep.id", F.lit(NO_ID)).alias("rep_id"), F.col("rep.key").alias("rep_key"), "bands", "signature"),
        "classes",
    )
    texts = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).where(F.col("text").isNotNull())
    bands = classes.select("cls", "bands").mapInArrow(_bands, "band long, cls long")
    shared = bands.groupBy("band").agg(F.min("cls").alias("center"), F.max("cls").alias("last")).where("center < last")
    members = written(bands.join(shared.select("band", "center"), "band"), "members")
    kept_texts = _texts_of(members, classes, texts)
    tried = members.where("cls != center").select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct()
    links = written(confirmed(tried, kept_texts, percent, width), "links")
    signs = classes.select("cls", "signature", F.lit(None).cast("binary").alias("sketch"))
    for step in ("pivots", "nearest", "rest"):
        found = written(components(links), "components")
        labelled = members.join(found.toDF("cls", "component"), "cls", "left").select("band", "cls", F.coalesce("component", "cls").alias("comp"))
        if step == "nearest":
            wanted = labelled.join(_still_open(labelled), "band").select("cls").distinct()
            sketches = kept_texts.join(wanted, "cls").mapInArrow(_sketches(width), "cls long, sketch binary").groupBy("cls").agg(F.first("sketch").alias("sketch"))
            signs = written(classes.select("cls", "signature").join(sketches, "cls"), "sketches")
        groups = _divided(labelled, signs).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        close = written(groups.mapInArrow(_close_pairs(step, percent / 100), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti"), "close")
        if close.isEmpty():
            continue
        links = written(links.unionByName(confirmed(close, kept_texts, percent, width)), "links")
        tried = tried.unionByName(close)
    found = written(components(links), "components")
    owner = classes.join(found.toDF("cls", "component"), "cls", "left").select("set_key", F.coalesce("component", "cls").alias("component"), F.when(F.col("rep_id") != NO_ID, F.col("rep_id")).alias("rep_id"))
    smallest = owner.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    named = owner.join(smallest, "component").select("set_key", "component", "component_id")
    result = stored.select("doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_key")).alias("set_key")).join(named, "set_key", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "text_key", "n_shingles", component_id.alias("component_id"), "component")
