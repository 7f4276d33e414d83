"""Fill-in-middle: texts cut at two unit ranks, found in an indexable skip list, and put in another order."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import id_and_text, mixed, raw_text, text_slices

#: A unit is a run of ASCII letters or one other character.
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, how many change their order, and of 100 of those, how many put the suffix first.
CHANGED, SUFFIX_FIRST = 90, 20
#: Bits of chance for each express lane: one in 2^LANE_BITS links of a lane is in the lane above.
LANE_BITS, LANES = 3, 6
#: Text bytes whose units are looked at in one step, however long the text is.
WINDOW_BYTES = 1 << 20
#: Bytes of texts that go out as one batch.
OUT_BYTES = 4 << 20
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_END = np.iinfo(np.int64).max


class SkipLists:
    """Indexable skip lists over the units of some texts, side by side.

    The bottom lane is the text itself. A link of an express lane carries its width in units and
    in code points; a text's first unit is the head of its list and is in every lane. Whether any
    other unit is in a lane is chance by its place, which changes the steps taken but no result.
    Only express lanes are stored, so a list takes about a fifth of the bytes of its text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
        towers: list[tuple[np.ndarray, ...]] = []
        unit_at, code_at = np.zeros(len(offsets), np.int64), np.zeros(len(offsets), np.int64)
        units = codes = 0
        for start in range(0, len(data), WINDOW_BYTES):
            end = min(start + WINDOW_BYTES, len(data))
            block = data[start:end]
            character = (block & 0xC0) != 0x80
            letter = _LETTER[block]
            before = np.concatenate([[start > 0 and bool(_LETTER[data[start - 1]])], letter[:-1]])
            own = heads[np.searchsorted(heads, start) : np.searchsorted(heads, end)] - start
            first = character & ~(letter & before)
            first[own] = True
            at = np.flatnonzero(first)
            code_no = codes + np.cumsum(character) - 1  # of the character that a byte belongs to
            unit_no = units + np.arange(len(at))
            height = np.zeros(len(at), np.int8)
            lots = mixed(unit_no.astype(np.uint64) + np.uint64(1))
            for lane in range(1, LANES + 1):
                height[(lots & np.uint64((1 << LANE_BITS * lane) - 1)) == 0] = lane
            height[np.searchsorted(at, own)] = LANES
            tall = np.flatnonzero(height)
            towers.append((unit_no[tall], code_no[at[tall]], height[tall]))
            bounds = slice(int(np.searchsorted(offsets, start)), int(np.searchsorted(offsets, end)))
            inside = offsets[bounds] - start
            unit_at[bounds] = units + np.searchsorted(at, inside)
            code_at[bounds] = codes + np.concatenate([[0], np.cumsum(character)])[inside]
            units, codes = units + len(at), codes + int(character.sum())
        unit_at[np.searchsorted(offsets, len(data)) :] = units
        code_at[np.searchsorted(offsets, len(data)) :] = codes
        self.n_units, self.n_codes, self.first_code = np.diff(unit_at), np.diff(code_at), code_at[:-1]
        unit, code, height = (np.concatenate(c) for c in zip(*towers, strict=True)) if towers else (np.zeros(0, np.int64),) * 3
        # The last place of each lane is its end, which no rank lies beyond.
        self.unit_width, self.code_width, self.down = [], [], []
        below = np.arange(len(unit))
        for lane in range(1, LANES + 1):
            at = np.flatnonzero(height >= lane)
            self.unit_width.append(np.append(np.diff(np.append(unit[at], units)), _END))
            self.code_width.append(np.append(np.diff(np.append(code[at], codes)), 0))
            self.down.append(np.append(np.searchsorted(below, at), len(below)))
            below = at
        self.head = np.searchsorted(unit[below], unit_at[:-1])

    def descend(self, texts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text and rank the code points and units up to the last link that doesn't pass the rank.

        All searches go down together: each takes links of its lane while their widths add up to
        no more than its rank, then goes on in the lane below.
        """
        at, units, codes = self.head[texts], np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for lane in range(LANES - 1, -1, -1):
            moving = np.arange(len(ranks))
            while len(moving):
                width = self.unit_width[lane][at[moving]]
                go = width <= ranks[moving] - units[moving]
                moving, width = moving[go], width[go]
                units[moving] += width
                codes[moving] += self.code_width[lane][at[moving]]
                at[moving] += 1
            at = self.down[lane][at]
        return codes, units

    def cut(self, text: str, codes: int, units: int, rank: int) -> int:
        """Code points before the unit ``rank``: the bottom lane from where ``descend`` ended."""
        while units < rank:
            codes, units = UNIT.match(text, codes).end(), units + 1
        return codes


def lots(doc_id: int | None) -> tuple[int, ...]:
    """The four numbers that decide over a document; a null id counts as no digits."""
    return struct.unpack(">4I", hashlib.sha256(b"1:%s" % (b"" if doc_id is None else b"%d" % doc_id)).digest()[:16])


def _transformed(part: pa.RecordBatch) -> Iterator[tuple]:
    lists = SkipLists(*raw_text(part.column("text")))
    drawn = np.array([lots(i) for i in part.column("doc_id").to_pylist()], np.int64).reshape(-1, 4)
    n = lists.n_units
    ranks = np.sort(drawn[:, :2] % (n[:, None] + 1), axis=1)
    open_ = np.flatnonzero((n > 0) & (drawn[:, 2] % 100 < CHANGED))
    codes, units = lists.descend(np.repeat(open_, 2), ranks[open_].ravel())
    place = {int(k): 2 * i for i, k in enumerate(open_)}
    for k, value in enumerate(part.column("text")):
        text, at = value.as_py() or "", place.get(k)
        if at is None or PREFIX in text or SUFFIX in text or MIDDLE in text:
            yield int(n[k]), "plain", None, None, text
            continue
        a, b = (lists.cut(text, int(codes[i]), int(units[i]), int(r)) for i, r in zip((at, at + 1), ranks[k], strict=True))
        first = drawn[k, 3] % 100 < SUFFIX_FIRST
        parts = (SUFFIX, text[b:], PREFIX, text[:a]) if first else (PREFIX, text[:a], SUFFIX, text[b:])
        yield int(n[k]), "spm" if first else "psm", a, b - a, "".join((*parts, MIDDLE, text[a:b]))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text in the order of the fill-in-middle task, cut at two of its units.

    Returns doc_id, n (units), form ("plain", "psm" or "spm"), prefix_chars and middle_chars (code
    points; null for "plain") and output. Cuts and form follow from a hash of the id alone, so
    reruns agree and rows with one id (or without) share their lots; a null id hashes as no
    digits. A null or empty text, or one that holds a marker, stays plain (null becomes empty).
    Repeated rows are transformed one by one, an empty table gives no rows, other columns are not
    read. A text of any length is walked in windows; a task holds one text, its output and lists
    of about a fifth of its size at a time.
    """
    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", OUT_BYTES):
                columns = [list(c) for c in zip(*_transformed(part), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    narrow = id_and_text(docs, id_col, text_col)
    return narrow.mapInArrow(transform, kind)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; markers can't occur in a text that was cut."""
    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    tail = F.substring(output, m + 3, F.length(output))
    psm = F.concat(F.substring(output, F.lit(4), s - 4), tail, F.substring(output, s + 3, m - s - 3))
    spm = F.concat(F.substring(output, p + 3, m - p - 3), tail, F.substring(output, F.lit(4), p - 4))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
