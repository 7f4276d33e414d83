"""Reading JSON arrays of any size: every split of a file finds its own elements.

Spark's text reader already cuts a file into splits at any byte that ends a record. With "}" as
that byte a split holds a stretch of the array, and only three things are not known inside it:
whether it starts in a string, how deep it starts, and the number of its first element. A first
pass counts quotes, brackets and commas for both cases; running sums over the splits of a file
settle the three; a second pass then takes the elements out. Elements that lie across splits are
put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.session import ensure_checkpoint_dir

#: The byte that ends a row of the text reader.
RECORD_END = "}"
#: Bytes that are looked at in one step.
STEP_BYTES = 1 << 20
#: Splits whose start states are sent to all tasks (some 60 bytes each); beyond, they are joined by shuffle.
BROADCAST_SPLITS = 200_000
_BLANK = np.isin(np.arange(256), list(b" \t\r\n"))
_QUOTE, _ESCAPE, _COMMA = ord('"'), ord("\\"), ord(",")
_STEP = np.zeros(256, np.int64)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1


def _unescaped_quotes(data: np.ndarray) -> np.ndarray:
    """Places of quotes behind an even number of backslashes; a stretch never starts behind a backslash."""
    quotes = np.flatnonzero(data == _QUOTE)
    slashes = data == _ESCAPE
    if not len(quotes) or not slashes.any():
        return quotes
    last_other = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(data))))
    return quotes[(quotes - 1 - np.concatenate([[-1], last_other])[quotes]) % 2 == 0]


def _marks(data: np.ndarray, in_string: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Brackets and commas outside strings: their places, bytes and the depth behind each, and the number of quotes."""
    quotes = _unescaped_quotes(data)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, quotes, 1)
    inside = ((np.cumsum(inside, dtype=np.int64) + in_string) & 1).astype(bool)[: len(data)]
    at = np.flatnonzero(((_STEP[data] != 0) | (data == _COMMA)) & ~inside)
    return at, data[at], np.cumsum(_STEP[data[at]]), len(quotes)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray]]:
    """Consecutive rows of a split as bytes, with the first row's other columns.

    The text reader takes the record ends off. All rows but the first of a file follow one, so it
    comes back in front of them, and the splits of a file together are the file again.
    """
    for batch in batches:
        names = [n for n in batch.schema.names if n != "value"]
        blocks, paths = batch.column("block").to_pylist(), batch.column("path").to_pylist()
        texts = batch.column("value").cast(pa.binary()).to_pylist()
        firsts = batch.column("first").to_pylist()
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and size < STEP_BYTES and (blocks[end], paths[end]) == (blocks[start], paths[start]):
                size += len(texts[end])
                end += 1
            lead = b"" if firsts[start] else RECORD_END.encode()
            text = lead + RECORD_END.encode().join(texts[start:end])
            yield {n: batch.column(n)[start].as_py() for n in names}, np.frombuffer(text, np.uint8)
            start = end


def _with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the mark of a file's very first one."""
    before = None
    for batch in batches:
        keys = list(zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True))
        first = [key[1] == 0 and key != last for key, last in zip(keys, [before, *keys], strict=False)]
        before = keys[-1] if keys else before
        yield batch.append_column("first", pa.array(first, pa.bool_()))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split and either start (outside or in a string) its quotes, depth change and commas by depth."""
    splits: dict[tuple, list[dict]] = {}
    for row, data in _steps(_with_first(batches)):
        states = splits.setdefault((row["path"], row["block"]), [{"in": s, "depth": 0, "commas": {}, "quotes": 0} for s in (False, True)])
        for state in states:
            _, byte, depth, quotes = _marks(data, state["in"])
            levels, counts = np.unique(depth[byte == _COMMA] + state["depth"], return_counts=True)
            for level, n in zip(levels.tolist(), counts.tolist(), strict=True):
                state["commas"][level] = state["commas"].get(level, 0) + n
            state["depth"] += int(depth[-1]) if len(depth) else 0
            state["in"] ^= bool(quotes % 2)
            state["quotes"] += quotes
    found = []
    for (path, block), (out, within) in splits.items():
        own = [x for s in (out, within) for x in (s["depth"], list(s["commas"]), list(s["commas"].values()))]
        found.append(dict(zip(_SUMMARY_SCHEMA.names, [path, block, out["quotes"], *own], strict=True)))
    yield pa.RecordBatch.from_pylist(found, _SUMMARY_SCHEMA)


_KINDS = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_(), "binary": pa.binary()}
_SUMMARY = "path string, block long, quotes long, depth_out long, levels_out array<long>, commas_out array<long>, depth_in long, levels_in array<long>, commas_in array<long>"
_PIECE = "path string, number long, block long, opened boolean, closed boolean, last boolean, text binary"
_SUMMARY_SCHEMA, _PIECE_SCHEMA = (pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in kind.split(", ")]) for kind in (_SUMMARY, _PIECE))


def split_states(summaries: DataFrame) -> DataFrame:
    """(path, block) with what holds at the start of each split: in_string, depth and element number."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split of a file

    def running(value):
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    def of_start(name):
        return F.when(F.col("in_string"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))

    own = F.try_element_at(F.map_from_arrays(of_start("levels"), of_start("commas")), 1 - F.col("depth"))
    return (
        summaries.withColumn("in_string", running(F.col("quotes")) % 2 == 1)
        .withColumn("depth", running(of_start("depth")))
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .select("path", "block", "in_string", "depth", running(F.col("own")).alias("number"))
    )


class _Split:
    """Takes the elements out of the steps of one split."""

    def __init__(self, row: dict):
        self.path, self.block, self.number = row["path"], row["block"], row["number"]
        self.in_string, self.depth = row["in_string"], row["depth"]
        self.opened, self.held = False, []
        self.before, self.ended = row["block"] == 0, row["block"] > 0 and row["depth"] == 0

    def _piece(self, closed: bool, last: bool) -> dict:
        piece = (self.path, self.number, self.block, self.opened, closed, last, b"".join(self.held))
        self.held, self.opened = [], True
        return dict(zip(_PIECE_SCHEMA.names, piece, strict=True))

    def _no_list(self) -> ValueError:
        return ValueError(f"expected a top-level JSON list in {self.path}")

    def take(self, data: np.ndarray) -> Iterator[dict]:
        """The pieces that end in these bytes."""
        at, byte, depth, quotes = _marks(data, self.in_string)
        depth = depth + self.depth
        edge = ((byte == _COMMA) & (depth == 1)) | ((_STEP[byte] > 0) & (depth == 1)) | ((_STEP[byte] < 0) & (depth <= 0))
        start = 0
        for place, mark in zip(at[edge].tolist(), byte[edge].tolist(), strict=True):
            if mark == _COMMA and not (self.before or self.ended):
                self.held.append(data[start:place].tobytes())
                yield self._piece(True, False)
                self.number += 1
            elif mark == ord("[") and self.before and _BLANK[data[start:place]].all():
                self.before, self.opened = False, True
            elif mark == ord("]") and not (self.before or self.ended):
                self.held.append(data[start:place].tobytes())
                yield self._piece(True, True)
                self.ended = True
            else:
                raise self._no_list()
            start = place + 1
        rest = data[start:]
        if not (self.before or self.ended):
            self.held.append(rest.tobytes())
        elif not _BLANK[rest].all():
            raise self._no_list()
        self.depth += int(depth[-1] - self.depth) if len(depth) else 0
        self.in_string ^= bool(quotes % 2)

    def rest(self) -> Iterator[dict]:
        """What is left open at the end of the split."""
        if not (self.before or self.ended):
            yield self._piece(False, False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for row, data in _steps(_with_first(batches)):
        found: list[dict] = []
        if split is None or (split.path, split.block) != (row["path"], row["block"]):
            found += split.rest() if split else []
            split = _Split(row)
        found += split.take(data)
        yield pa.RecordBatch.from_pylist(found, _PIECE_SCHEMA)
    if split:
        yield pa.RecordBatch.from_pylist(list(split.rest()), _PIECE_SCHEMA)


def read_elements(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Elements of files that hold one JSON array each, as text: (path, number, text).

    A file is read by as many tasks as it has splits. Numbers count the elements of a file from 0
    on. Another root than a list, an array that isn't closed, or text behind it is an error;
    what an element holds isn't checked here. An empty file has no elements.
    """
    ensure_checkpoint_dir(spark)
    rows = spark.read.option("lineSep", RECORD_END).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    states = split_states(rows.mapInArrow(_summaries, _SUMMARY)).checkpoint()
    if states.count() <= BROADCAST_SPLITS:
        located = rows.join(F.broadcast(states), ["path", "block"])
    else:
        order = rows.withColumn("row_no", F.monotonically_increasing_id())  # ascending within a split
        located = order.join(states, ["path", "block"]).repartition("path", "block").sortWithinPartitions("path", "block", "row_no")
    pieces = located.select("path", "block", "in_string", "depth", "number", "value").mapInArrow(_pieces, _PIECE)
    whole = F.col("opened") & F.col("closed")
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))  # of one element
    joined = pieces.where(~whole).groupBy("path", "number").agg(
        F.bool_or("opened").alias("opened"), F.bool_or("closed").alias("closed"), F.bool_or("last").alias("last"),
        F.array_join(F.transform(parts, lambda p: p["text"].cast("string")), "").alias("text"),
    )
    open_end = F.raise_error(F.concat(F.lit("the JSON list isn't closed in "), F.col("path"))).cast("string")
    checked = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(open_end))
    every = pieces.where(whole).withColumn("text", F.col("text").cast("string")).select(*checked.columns).unionByName(checked)
    empty = (F.col("number") == 0) & F.col("last") & (F.btrim("text", F.lit(" \t\r\n")) == "")
    return every.where(~empty).select("path", "number", "text")


def read_arrays(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Files that hold one JSON array each: (raw, path), each element a VARIANT; see ``read_elements``."""
    return read_elements(spark, paths).select(F.parse_json("text").alias("raw"), "path")


def write_arrays(elements: DataFrame, path: str) -> None:
    """Write elements (one column of JSON text) as a folder of files that hold one array each."""

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                yield pa.RecordBatch.from_pydict({"value": [lead + texts[0], *("," + t for t in texts[1:])]})
                lead = ","
        yield pa.RecordBatch.from_pydict({"value": ["[]" if lead == "[" else "]"]})

    elements.mapInArrow(bracketed, "value string").write.text(path)
