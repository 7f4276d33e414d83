"""Vector codes by product quantization, its codebooks trained by member-resident Lloyd rounds.

Parts of vectors lie in the partition of their (position, entry, salt). In each round the tasks
assign their resident members to the nearest entry; members that keep their entry stay where they
are, the others go to their new entry's partition in the next shuffle, and the new entry follows
from the sums of its residents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import discard, written

POSITIONS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Members of an entry for each salt; an entry with more is divided among partitions.
CELL_ROWS = 200_000
#: Scaled components are held within this bound, so that distances and sums fit 64 bits.
BOUND = 1 << 25
#: Distances that are computed in one step.
STEP = 1 << 21


@dataclass
class Codebooks:
    """The entries of each position: int64[positions, entries, width of a part]."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        """Components of a vector, filled up to whole parts."""
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Hash of all components by part, entry and place, as decimals divided by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, vector (as doubles) and label of the rows without a null or non-finite component."""
    vector, label = F.col("vector"), F.col(label_col) if label_col in vectors.columns else F.lit(None).cast("int")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    narrow = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), label.alias("label"))
    return narrow.where(vector.isNotNull() & finite)


def scaled(column, width: int, positions: int = POSITIONS) -> np.ndarray:
    """Integer parts of vectors, int64[rows, positions, width / positions]; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths()).astype(np.int64)
    values = np.clip(np.floor(np.asarray(column.flatten(), np.float64) * SCALE), -BOUND, BOUND).astype(np.int64)
    if len(sizes) and (sizes != width).any():
        row, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        full = np.zeros((len(sizes), width), np.int64)
        full[row, place] = values
        values = full
    return values.reshape(len(sizes), positions, width // positions)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the lower index, and the squared distance; all in whole numbers."""
    n, width = parts.shape
    at, far = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not width:
        return at, far
    largest = max(int(np.abs(parts).max()), int(np.abs(entries).max()))
    exact = 4 * largest * largest * width < 1 << 53  # then doubles hold every sum
    some = max(1, STEP // (len(entries) * (1 if exact else width)))
    norms = (entries * entries).sum(1)
    for a in range(0, n, some):
        x = parts[a : a + some]
        if exact:
            near = norms - 2.0 * (x.astype(np.float64) @ entries.T.astype(np.float64))
            best = near.argmin(1)
        else:
            best = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(2).argmin(1)
        at[a : a + some], far[a : a + some] = best, ((x - entries[best]) ** 2).sum(1)
    return at, far


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _rows(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel().astype(np.int32)))


def _dealt(width: int, positions: int):
    """The parts of each vector, still without an entry."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = scaled(batch.column("vector"), width, positions)
            none = pa.array(np.full(batch.num_rows, -1, np.int32))
            for p in range(positions):
                arrays = [pa.array(np.full(batch.num_rows, p, np.int32)), none, none, batch.column("key"), _rows(parts[:, p])]
                yield pa.RecordBatch.from_arrays(arrays, ["position", "entry", "nearest", "key", "part"])

    return deal


def _assigned(shared):
    """Resident members with their nearest entry of now."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        for batch in batches:
            position, parts, found = np.asarray(batch.column("position")), _matrix(batch.column("part")), np.zeros(batch.num_rows, np.int32)
            for p in np.unique(position):
                own = np.flatnonzero(position == p)
                found[own] = nearest(parts[own], entries[p])[0]
            yield pa.RecordBatch.from_arrays([batch.column("position"), batch.column("nearest"), pa.array(found), batch.column("key"), batch.column("part")], ["position", "entry", "nearest", "key", "part"])

    return assign


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and componentwise sums of a task's residents for each of their entries."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = _matrix(batch.column("part"))
        position, entry = np.asarray(batch.column("position")).astype(np.int64), np.asarray(batch.column("nearest"))
        cell = position << 32 | entry
        order = np.argsort(cell, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(cell[order]) != 0]))
        counted = np.concatenate([np.ones((len(cell), 1), np.int64), parts], 1)
        for k, sums in zip(cell[order[first]].tolist(), np.add.reduceat(counted[order], first, axis=0), strict=True):
            at = (k >> 32, k & 0xFFFFFFFF)
            held[at] = held[at] + sums if at in held else sums
    keys, sums = list(held), list(held.values())
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.int32()), pa.array([s.tolist() for s in sums], pa.list_(pa.int64()))],
        ["position", "entry", "sums"],
    )


def _updated(members: DataFrame, entries: np.ndarray) -> np.ndarray:
    """New entries, floor(sum / count) of their members; unused entries stay.

    What comes to the driver is a row for each entry of the codebooks.
    """
    width = entries.shape[2]
    partial = members.select("position", "nearest", "part").mapInArrow(_summed, "position int, entry int, sums array<long>")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width + 1)]
    new = entries.copy()
    for r in partial.groupBy("position", "entry").agg(*sums).collect():
        new[r.position, r.entry] = [r[3 + i] // r[2] for i in range(width)]
    return new


def _migrated(now: DataFrame, entries: int, cell_rows: int) -> DataFrame:
    """Members that change their entry, in the partition of their (position, new entry, salt), stored.

    An entry has as many salts as its members need; the counts are a row for each entry.
    """
    counts = now.groupBy("position", "nearest").count().where(F.col("count") > cell_rows).collect()
    salts = F.lit(1)
    if counts:
        full = {r.position * entries + r.nearest: -(-r["count"] // cell_rows) for r in counts}
        cell = F.col("position") * entries + F.col("nearest")
        salts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in full.items() for x in kv]), cell), salts)
    salted = now.where("nearest != entry").withColumn("salt", F.pmod(F.col("key"), salts))
    return written(salted.repartition("position", "nearest", "salt").drop("salt"), "codes-moved")


def train(rows: DataFrame, width: int, positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS, cell_rows: int = CELL_ROWS) -> Codebooks:
    """Codebooks after ``rounds`` rounds, from those of the ``entries`` smallest ids.

    ``rows`` has vec_id and vector (see ``usable``). All sums are whole numbers, so results
    depend on no partition. Of rows with one id those with the smaller vector come first, null
    ids come last. Without a row there is no entry.
    """
    spark = rows.sparkSession
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").toArrow()
    start = scaled(first.column("vector"), width, positions)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    if not len(start) or not width:
        return Codebooks(books)
    keyed = rows.select(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()).alias("key"), "vector")
    kind = "position int, entry int, nearest int, key long, part array<int>"
    members, homes = keyed.mapInArrow(_dealt(width, positions), kind), []
    for _ in range(rounds):
        now = written(members.mapInArrow(_assigned(spark.sparkContext.broadcast(books)), kind), "codes-members")
        arrived = _migrated(now, books.shape[1], cell_rows)
        discard(*homes)
        homes, members = [now, arrived], now.where("nearest = entry").unionByName(arrived)
        books = _updated(members, books)
    discard(*homes)
    return Codebooks(books)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits for each part) and error of every usable row."""
    shared = rows.sparkSession.sparkContext.broadcast(books.entries)
    width = books.width

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        for batch in batches:
            parts = scaled(batch.column("vector"), width, len(entries))
            found = [nearest(parts[:, p], own) for p, own in enumerate(entries)]
            codes = np.stack([at for at, _ in found], 1).astype(np.uint8).tobytes().hex()
            digits = 2 * len(entries)
            error = sum(far for _, far in found)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([codes[i : i + digits] for i in range(0, len(codes), digits)], pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "vector").mapInArrow(code, f"vec_id long, label {dict(rows.dtypes)['label']}, code string, error long")


def compress(vectors: DataFrame, positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Code of every vector by codebooks trained on all of them.

    Returns vec_id, label, code, error (squared distance to the coded vector), label_error (the
    error of all rows with the same label; null labels are one) and codebooks_sha256. Vectors that
    are null or hold a null or non-finite component take no part. Components are scaled by 1024,
    rounded down and held within 2^25. Vectors are cut into parts of equal length; one that is
    shorter than the longest, or a length that can't be divided, is filled up with zeros. At most
    256 entries. Repeated rows and ids count each by itself; null ids come last where ids decide;
    an empty table gives no rows; other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits for each part")
    rows = usable(vectors, id_col, vector_col, label_col)
    longest = rows.agg(F.max(F.size("vector")).alias("n")).first().n or 0
    books = train(rows, -(-longest // positions) * positions, positions, entries, rounds)
    if not books.entries.size and not longest:
        books = Codebooks(np.zeros((positions, 1, 0), np.int64))
    coded = written(encode(rows, books), "codes")
    # One row for each label; a label of very many rows is summed up before it moves.
    by_label = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    met = coded.alias("c").join(by_label.alias("l"), F.expr("c.label <=> l.label"))
    return met.select("vec_id", "c.label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
