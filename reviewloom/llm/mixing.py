"""Mixing sources to target weights: balanced sampling by the cube method."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import SPACE, by_place, cut

#: Documents per flight; a task holds one such group.
CHUNK = 20_000
#: Copies of a row that are written out in one go.
REPEAT_BLOCK = 10_000
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2
EDGE = 1e-9


def word_count(text):
    """Number of words of a text column; null has none."""
    words = F.split(F.btrim(F.translate(text, SPACE, " " * len(SPACE))), " +")
    return F.when(F.btrim(text, F.lit(SPACE)) == "", 0).otherwise(F.coalesce(F.size(words), F.lit(0))).cast("long")


def source_targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> list[float]:
    """Targets in proportion to repeating weights; what is above ``most`` times a size is shared again."""
    targets, open_ = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}
    left = share * sum(sizes)
    while open_:
        unit = left / sum(weights[i % len(weights)] for i in sorted(open_))
        full = [i for i in sorted(open_) if unit * weights[i % len(weights)] > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i % len(weights)]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
            open_.remove(i)
    return targets


def _step(chances, sizes, draw, keep_count: bool = True):
    """Move three (or two) chances along a vector that keeps their totals until one is 0 or 1."""
    if len(chances) == 3:
        a, b, c = sizes
        move = (c - b, a - c, b - a) if not a == b == c else (1.0, -1.0, 0.0)
    elif keep_count:
        move = (1.0, -1.0)  # only called for equal sizes
    else:
        move = (float(sizes[1]), -float(sizes[0]))
    ahead = min((1 - p) / m if m > 0 else p / -m for p, m in zip(chances, move, strict=True) if m)
    back = min(p / m if m > 0 else (1 - p) / -m for p, m in zip(chances, move, strict=True) if m)
    by = ahead if draw * (ahead + back) < back else -back
    return [p + by * m for p, m in zip(chances, move, strict=True)]


def flight(chances: np.ndarray, sizes: np.ndarray, seed: int, land: bool) -> np.ndarray:
    """Chances moved to 0 or 1 while their sum and their size-weighted sum stay; at most two stay open.

    With ``land`` the open ones are settled too: first only the size total is kept, then the last
    one is drawn.
    """
    done = chances.astype(float).copy()
    draws = np.random.default_rng(seed).random(2 * len(done) + 4)
    waiting = iter([int(i) for i in np.flatnonzero((done > EDGE) & (done < 1 - EDGE))])
    active: list[int] = []
    for n_draw in range(len(draws)):
        while len(active) < 3 and (i := next(waiting, None)) is not None:
            active.append(i)
        if len(active) < 3 and not (len(active) == 2 and sizes[active[0]] == sizes[active[1]]):
            break
        moved = _step([done[i] for i in active], [float(sizes[i]) for i in active], draws[n_draw])
        for i, p in zip(active, moved, strict=True):
            done[i] = p
        active = [i for i in active if EDGE < done[i] < 1 - EDGE]
    if land and len(active) == 2:
        moved = _step([done[i] for i in active], [max(float(sizes[i]), 1e-3) for i in active], draws[-2], False)
        for i, p in zip(active, moved, strict=True):
            done[i] = p
        active = [i for i in active if EDGE < done[i] < 1 - EDGE]
    if land:
        for i in active:
            done[i] = float(draws[-1] < done[i])
    settled = (done <= EDGE) | (done >= 1 - EDGE)
    done = np.where(settled, np.round(done), done)
    return _exchanged(chances, done, sizes) if land else done


def _exchanged(chances: np.ndarray, done: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Make up for the landing: one large document left open can miss the size total by its size.

    Turns the drawn or left-out document whose size is nearest to the miss, while that helps.
    """
    open_ = (chances > EDGE) & (chances < 1 - EDGE)
    miss = float((sizes * (done - chances)).sum())
    while True:
        can = np.flatnonzero(open_ & (done == (1.0 if miss > 0 else 0.0)) & (sizes > 0))
        if not len(can):
            return done
        best = can[np.argmin(np.abs(sizes[can] - abs(miss)))]
        if abs(abs(miss) - sizes[best]) >= abs(miss):
            return done
        miss -= float(sizes[best]) * (1.0 if miss > 0 else -1.0)
        done[best], open_[best] = 1.0 - done[best], False


def _flown(land: bool, level: int):
    def fly(rows: pd.DataFrame) -> pd.DataFrame:
        # Large documents first: those left open, and so the landing, are among the smallest.
        rows = rows.sort_values(["size", "order_key", "row_no"], ascending=[False, True, True], ignore_index=True)
        seed = int(rows["source_no"].iloc[0]) * 1_000_003 + int(rows["chunk"].iloc[0]) * 101 + level
        rows["chance"] = flight(rows["chance"].to_numpy(), rows["size"].to_numpy(), seed, land)
        return rows

    return fly


def numbered(rows: DataFrame, times: str, number: str) -> DataFrame:
    """Each row as often as its column ``times`` says, with a number from 0 on.

    A row that stands for very many goes in blocks, which are spread over all tasks.
    """
    block = F.expr(f"explode(sequence(0L, ({times} - 1) div {REPEAT_BLOCK}))")
    many = rows.where(F.col(times) > REPEAT_BLOCK).withColumn("_block", block).repartition(F.xxhash64(F.struct(times, "_block")), "_block")
    few = rows.where(F.col(times).between(1, REPEAT_BLOCK)).withColumn("_block", F.lit(0).cast("long"))
    within = F.expr(f"explode(sequence(_block * {REPEAT_BLOCK}, least({times}, (_block + 1) * {REPEAT_BLOCK}) - 1))")
    return few.unionByName(many).withColumn(number, within).drop("_block")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    chunk: int = CHUNK,
) -> DataFrame:
    """Copies of every document so that each source comes to its target number of words.

    Returns doc_id, source, size, source_size, target, copies, taken (= copies x size) and
    text_hash. A source whose target is e times its size takes every document floor(e) times and
    draws further ones with chance e - floor(e); the draw keeps the number of documents and of
    words (cube method). Chunks of a source fly apart from each other, what stays open flies
    together on the next level, and each source lands once. Null text: size 0. A null source
    comes last. Repeated rows are drawn one by one. An empty table gives no rows. What comes to
    the driver and goes to the tasks is a row for each source: tens of thousands, not hosts. Draws depend
    on ids and sizes, so reruns agree.
    """
    spark = docs.sparkSession
    frame, (id_col, text_col, source_col) = by_place(docs, id_col, text_col, source_col)
    narrow = frame.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    # Equal rows are interchangeable: they are counted before they move, then numbered, in any layout of the table.
    counted = cut(narrow.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("n")))
    units = cut(numbered(counted, "n", "row_no").drop("n"))
    # One row per source, in code point order (byte order of UTF-8), null last.
    totals = units.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    totals.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    targets = source_targets([r.size for r in totals], weights, share)
    plan, parts = [], {}
    for i, (r, target) in enumerate(zip(totals, targets, strict=True)):
        times = min(target / r.size, float(MOST_COPIES)) if r.size else 0.0
        parts[i] = -(-r.n // chunk)
        plan.append((i, r.source, r.size, target, int(times + EDGE), max(0.0, times - int(times + EDGE)), parts[i]))
    kind = "source_no int, source string, source_size long, target double, base int, chance double, parts int"
    sources = F.broadcast(spark.createDataFrame(plan, kind))
    u, s = units.alias("u"), sources.alias("s")
    opened = u.join(s, F.expr("u.source <=> s.source")).select(
        "u.doc_id", "u.size", "u.text_hash", "u.row_no", "source_no", "chance",
        F.xxhash64("u.doc_id", "u.text_hash").alias("order_key"),
        F.expr("cast(pmod(xxhash64(u.doc_id, u.text_hash, u.row_no), parts) as int)").alias("chunk"),
    )
    settled, level = [], 0
    while True:
        land = max(parts.values(), default=1) <= 1
        flown = cut(opened.groupBy("source_no", "chunk").applyInPandas(_flown(land, level), opened.schema))
        whole = (F.col("chance") == 0) | (F.col("chance") == 1)
        settled.append(flown.where(whole))
        if land:
            break
        # At most two documents of a chunk are still open.
        parts, level = {i: -(-2 * n // chunk) for i, n in parts.items()}, level + 1
        number = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("source_no"))
        opened = flown.where(~whole).withColumn("chunk", F.pmod(F.xxhash64("order_key", "row_no"), number).cast("int"))
    drawn = settled[0]
    for more in settled[1:]:
        drawn = drawn.unionByName(more)
    copies = (F.col("base") + F.col("d.chance").cast("int")).cast("int")
    return (
        drawn.alias("d")
        .join(sources.alias("s"), "source_no")
        .select(
            "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
            (copies * F.col("size")).cast("long").alias("taken"), "text_hash",
        )
    )


def mixed_documents(docs: DataFrame, drawn: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of a mix, each as often as it was drawn, with the columns of ``docs``.

    Null ids, texts and sources are values like others; other columns may have any name. Rows
    with the same id, text and source share their copies, one more for those first in order of a
    hash of the whole row, so that no group of such rows is numbered in one task. An empty table
    gives no rows.
    """
    frame, (id_, text, source) = by_place(docs, id_col, text_col, source_col)
    ours = frame.select(
        F.struct(*frame.columns).alias("_row"), F.col(id_).cast("long").alias("_id"), F.col(source).cast("string").alias("_source"), F.xxhash64(text).alias("_hash"),
    )
    theirs = cut(
        drawn.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"))
        .agg(F.count("*").alias("rows"), F.sum("copies").cast("long").alias("total")).where("total > 0")
    )
    same = F.expr("a._id <=> b._id AND a._source <=> b._source AND a._hash = b._hash")
    met = ours.alias("a").join(theirs.alias("b"), same).select("_row", "a._id", "a._source", "a._hash", "rows", "total")
    found = numbered(met.where("rows = 1").select("_row", "total"), "total", "_copy").select("_row.*")
    if not theirs.where("rows > 1").isEmpty():
        found = found.unionByName(_shared_copies(met.where("rows > 1"), [c for c, kind in frame.dtypes if "map<" not in kind and "variant" not in kind]))
    return found.toDF(*docs.columns)


def _shared_copies(met: DataFrame, hashed: list[str]) -> DataFrame:
    """Rows of groups with several rows for one key; equal rows are one with a count.

    A row's place in its group is a prefix sum in two levels, over 4,096 ranges of the row's hash
    and within a range.
    """
    key = ["_id", "_source", "_hash"]
    full = F.xxhash64(*[F.col(f"_row.{c}") for c in hashed])
    variants = cut(met.groupBy(*key, "rows", "total", full.alias("_full")).agg(F.count("*").alias("n"), F.first("_row").alias("_row")).withColumn("_range", F.shiftright("_full", 52)))
    upto = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = variants.groupBy(*key, "_range").agg(F.sum("n").alias("n")).withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
    within = Window.partitionBy(*key, "_range").orderBy("_full").rowsBetween(Window.unboundedPreceding, -1)
    v, r = variants.withColumn("_own", F.coalesce(F.sum("n").over(within), F.lit(0))).alias("v"), ranges.alias("r")
    same = F.expr("v._id <=> r._id AND v._source <=> r._source AND v._hash = r._hash AND v._range = r._range")
    place = F.col("_before") + F.col("_own")
    more = F.greatest(F.least(F.col("total") % F.col("rows") - place, F.col("n")), F.lit(0))
    times = F.expr("total div rows") * F.col("n") + more
    return numbered(v.join(r, same).select("_row", times.alias("_times")), "_times", "_copy").select("_row.*")
