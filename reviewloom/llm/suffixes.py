"""Exact substring dedup: interval expansion on a Burrows-Wheeler transform, bounded by a length.

Texts are cut into segments so that equal strings of the minimum length always meet in one
bucket: a window's anchor is the smallest hash among the k-grams in it, and a segment is a run of
windows with one anchor. Only segments whose anchor occurs in two documents go on, each content
once for a part of the documents. Where an anchor has one content all its windows are equal; where
it has very many, its windows are matched one by one by their hashes, which spread over all buckets;
the other segments form a text for each bucket, whose Burrows-Wheeler transform is expanded breadth
first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.llm.common import by_place, give_back, mixed

LEAST = 50
#: Bytes of a k-gram that may be an anchor.
GRAM = 20
#: Text bytes of a part (documents that are cut up together), and buckets for each part.
PART_BYTES, BUCKETS_PER_PART = 8 << 20, 3
#: Contents of an anchor (each once for a part) up to which one bucket holds them; beyond, its windows are dealt one by one.
ANCHOR_CONTENTS = 10_000
#: Bytes that one numpy step works on.
STEP_BYTES = 1 << 20
#: Windows of a segment at most; a longer run with one anchor is several. Hashes are polynomials modulo 2^64,
#: which only strings of over a thousand bytes can defeat by their form.
SEGMENT_WINDOWS = 64
#: No byte of UTF-8: divides segments.
DIVIDER = 0xFF
NO_ID = -(1 << 63)
#: Bits of hashes that are moved to find repeated anchors and whether their contents differ.
ANCHOR_SHIFT = 16
ANCHOR_BITS, CONTENT_BITS = -(1 << ANCHOR_SHIFT), (1 << 40) - 1
#: Above a content's bits: whether the part has others, and how many, counted up to more than any bucket takes.
CONTENT_SHIFT, COUNT_SHIFT, MOST_COUNTED = 40, 41, 1 << 21
_BASE = np.uint64(0x9FB21C651E98DF25)
_POWER: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWER or len(_POWER[0]) < n:
        size = 1 << int(n - 1).bit_length()
        _POWER.clear()
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _POWER.append(np.multiply.accumulate(values))
    return _POWER[0], _POWER[1]


class Hasher:
    """Hashes of any substring of some bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        n = max(len(self.sums) - size, 0)
        return mixed((self.sums[size : size + n] - self.sums[:n]) * self.down[:n])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        step = width - done
        values = np.minimum(values[:-step], values[step:])
    return values


def segments(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, gram: int = GRAM):
    """Segments of texts: (text number, first byte, end byte, anchor, hash of the content)."""
    if len(data) < least:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    hasher = Hasher(data)
    anchor = sliding_min(hasher.grams(gram), least - gram + 1)  # one for each window
    sizes = np.diff(offsets)
    inside = np.zeros(len(data) + 1, np.int32)
    whole = sizes >= least
    np.add.at(inside, offsets[:-1][whole], 1)
    np.add.at(inside, (offsets[1:] - least + 1)[whole], -1)
    inside = np.cumsum(inside)[: len(anchor)] > 0  # the window lies in one text
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    new = inside & (first[: len(anchor)] | np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~inside[:-1]]))
    start = np.flatnonzero(new)
    # A segment's last window is the one before the next start or before a window that lies in no text.
    stops = np.flatnonzero(inside & np.concatenate([new[1:] | ~inside[1:], [True]]))
    if len(start) and int((stops - start).max()) >= SEGMENT_WINDOWS:
        parts = (stops - start) // SEGMENT_WINDOWS + 1
        run = np.repeat(np.arange(len(start)), parts)
        step = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, last = start[run] + step * SEGMENT_WINDOWS, stops[run]
        stops = np.minimum(start + SEGMENT_WINDOWS - 1, last)
    end = stops + least
    text = np.searchsorted(offsets, start, "right") - 1
    # A minimum of hashes is small as a rule; mixed again, anchors spread evenly.
    return text, start, end, mixed(anchor[start]).view(np.int64), hasher.spans(start, end).view(np.int64)


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the rank of each (equal keys have one rank)."""
    order = np.argsort(keys)
    ordered = keys[order]
    rank = np.empty(len(keys), np.uint64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64)
    return order, rank


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes or a few more; ties are in any order."""
    n = len(text)
    padded = np.concatenate([text, np.full(8, DIVIDER, np.uint8)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for j in range(8):
        keys = keys << np.uint64(8) | padded[j : j + n]
    order, rank = _dense(keys)
    done = 8
    while done < depth:
        # As many ranks as fit a number; each round sorts anew.
        bits = max(int(rank[order[-1]]).bit_length(), 1)
        times, keys = min(64 // bits, -(-depth // done)), rank
        for j in range(1, times):
            after = np.zeros(n, np.uint64)
            after[: max(n - j * done, 0)] = rank[j * done :]
            keys = keys << np.uint64(bits) | after
        order, rank = _dense(keys)
        done *= times
    return order


def common_prefix_levels(bwt: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order the common prefix with the place before, or -1 if ``least`` or more.

    Breadth-first backward extension: the intervals of strings of one length are extended to the
    left by every byte that precedes them; where an interval ends that no shorter string ended,
    the common prefix is that length. Values so come in increasing order, and the work stops at
    ``least``. All intervals of a length are taken in one step.
    """
    n = len(bwt)
    back = np.empty(n, np.int64)
    back[np.argsort(bwt, kind="stable")] = np.arange(n)  # where the suffix one to the left is
    byte_at = np.sort(bwt)  # its first byte
    levels = np.full(n + 1, -1, np.int16)
    levels[0] = levels[n] = 0
    place, mine = np.arange(n), np.zeros(n, np.int32)  # the places of all intervals, and each one's interval
    owner, seen = np.empty(n, np.int32), np.zeros(n, bool)
    for length in range(least):
        image = back[place]
        owner[image] = mine
        seen[image] = True
        image = np.flatnonzero(seen)  # in order, without a sort
        seen[image] = False
        mine, byte = owner[image], byte_at[image]
        # An interval's places with one byte have neighbouring images.
        begin = np.flatnonzero(np.concatenate([[True], (mine[1:] != mine[:-1]) | (byte[1:] != byte[:-1])]))
        size = np.diff(np.append(begin, len(image)))
        high = image[begin] + size
        open_ = levels[high] < 0
        levels[high[open_]] = length
        if not open_.any():
            break
        place, size = image[np.repeat(open_, size)], size[open_]
        mine = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return levels[:n]


def shared_windows(contents: list[bytes], owners: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """For each window of each content the smallest owner of an equal window in any content."""
    found, count = _shared_windows(contents, owners, least)
    return np.split(found, np.cumsum(count)[:-1])


def _shared_windows(contents: list[bytes], owners: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``shared_windows`` of all contents one after another, and how many each has."""
    sizes = np.array([len(c) for c in contents], np.int64)
    text = np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order = suffix_order(text, least)
    levels = common_prefix_levels(text[order - 1], least)
    whose = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = np.repeat(start + sizes, sizes + 1) - np.arange(len(text))  # bytes up to the divider
    valid = left >= least
    value = np.where(valid, owners[whose], np.iinfo(np.int64).max)[order]
    group = np.flatnonzero(levels >= 0)  # the first place has level 0
    least_owner = np.minimum.reduceat(value, group)
    found = np.empty(len(text), np.int64)
    found[order] = np.repeat(least_owner, np.diff(np.append(group, len(text))))
    return found[valid], np.maximum(sizes - least + 1, 0)


def _texts(table: pa.Table):
    """A part's documents in steps: ids, bytes, offsets."""
    for batch in table.to_batches():
        ids = batch.column("doc_id").fill_null(NO_ID)
        raw = batch.column("text").cast(pa.binary()).fill_null(b"")
        sizes = np.asarray(pa.compute.binary_length(raw)).astype(np.int64)
        step = np.cumsum(sizes) // STEP_BYTES
        edges = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                offsets = np.concatenate([[0], np.cumsum(sizes[a:b])])
                data = np.frombuffer(b"".join(raw.slice(a, b - a).to_pylist()), np.uint8)
                yield np.asarray(ids)[a:b], data, offsets
    give_back()


def to_planes(values: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Numbers of each row as bytes, all lowest bytes first, then all second ones, and so on.

    What numbers have in common, such as high bytes of zero, so lies together and compresses.
    """
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    begin = (ends - sizes)[row]
    place, step = 8 * begin + np.arange(len(values)) - begin, sizes[row]
    flat, split = np.empty(8 * len(values), np.uint8), np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    for k in range(8):
        flat[place + k * step] = split[:, k]
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], 8 * ends]).astype(np.int32)), pa.py_buffer(flat)])


def from_planes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows one after another (uint64), and how many each row has."""
    rows = column.to_pylist()
    sizes = np.array([len(r) for r in rows], np.int64) // 8
    flat, row = np.frombuffer(b"".join(rows), np.uint8), np.repeat(np.arange(len(sizes)), sizes)
    begin = (np.cumsum(sizes) - sizes)[row]
    place, step, values = 7 * begin + np.arange(len(row)), sizes[row], np.zeros(len(row), np.uint64)
    for k in range(8):
        values |= flat[place + k * step].astype(np.uint64) << np.uint64(8 * k)
    return values, sizes


def packed_anchors(anchor: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Ascending anchors of each row as differences."""
    values = anchor.view(np.uint64) >> np.uint64(ANCHOR_SHIFT)
    gaps = np.diff(values, prepend=np.zeros(1, np.uint64))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    gaps[first] = values[first]
    return to_planes(gaps, sizes)


def unpacked_anchors(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of all rows and the number in each row."""
    gaps, sizes = from_planes(column)
    reach = np.concatenate([np.zeros(1, np.uint64), np.cumsum(gaps, dtype=np.uint64)])
    before = reach[np.cumsum(sizes) - sizes]
    return ((reach[1:] - np.repeat(before, sizes)) << np.uint64(ANCHOR_SHIFT)).view(np.int64), sizes


def _anchors(buckets: int):
    def find(table: pa.Table) -> pa.Table:
        """For each bucket the anchors of a part: the smallest content, whether there are others, and how many.

        A content that is in two documents of the part counts twice. All three share one number.
        """
        kept: list[list[np.ndarray]] = [[], [], [], []]
        for ids, data, offsets in _texts(table):
            text, _, _, anchor, key = segments(data, offsets)
            for values, new in zip(kept, _spread(anchor, key, ids[text], ids[text]), strict=True):
                values.append(new)
        anchor, key, low, high = _spread(*[np.concatenate(v) if v else np.zeros(0, np.int64) for v in kept])
        if not len(anchor):
            return pa.table([pa.array([], t) for t in ANCHORS.types], schema=ANCHORS)
        anchor, key, times = anchor & ANCHOR_BITS, key & CONTENT_BITS, 1 + (low < high).astype(np.int64)
        order = np.argsort(anchor.view(np.uint64))
        anchor, key, times = anchor[order], key[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        least, most = np.minimum.reduceat(key, first), np.maximum.reduceat(key, first)
        count = np.minimum(np.add.reduceat(times, first), MOST_COUNTED)
        anchor, packed = anchor[first], count << COUNT_SHIFT | (least != most).astype(np.int64) << CONTENT_SHIFT | least
        bucket = ((anchor.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)  # ascending, as anchors are
        names, sizes = np.unique(bucket, return_counts=True)
        part = np.full(len(names), table.column("part")[0].as_py(), np.int32)
        return pa.table([pa.array(names), pa.array(part), packed_anchors(anchor, sizes), to_planes(packed.view(np.uint64), sizes)], schema=ANCHORS)

    return find


def _repeated(table: pa.Table) -> pa.Table:
    """For each part the anchors of a bucket that are in two documents, and of which kind each is.

    Kind 0 has one content, kind 1 several that fit a bucket, kind 2 more than that.
    """
    anchor, sizes = unpacked_anchors(table.column("anchors"))
    if not len(anchor):
        return pa.table([pa.array([], t) for t in REPEATED.types], schema=REPEATED)
    packed = from_planes(table.column("contents"))[0].view(np.int64)
    order = np.argsort(anchor, kind="stable")
    group = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]]))
    packed = packed[order]
    content, count = packed & CONTENT_BITS, np.add.reduceat(packed >> COUNT_SHIFT, group)
    others = np.maximum.reduceat(packed >> CONTENT_SHIFT & 1, group) > 0
    varied = others | (np.minimum.reduceat(content, group) != np.maximum.reduceat(content, group))
    kind = np.where(~varied, 0, np.where(count <= ANCHOR_CONTENTS, 1, 2)).astype(np.uint8)
    members = np.diff(np.append(group, len(anchor)))
    own = np.empty(len(anchor), np.uint8)
    own[order] = np.repeat(np.where(count > 1, kind, 255), members).astype(np.uint8)
    wanted = np.flatnonzero(own < 255)  # in the order of rows, and ascending in each
    row = np.repeat(np.arange(len(sizes)), sizes)[wanted]
    rows, sizes = np.unique(row, return_counts=True)
    kinds = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(own[wanted])])
    return pa.table([table.column("part").take(pa.array(rows)).combine_chunks(), packed_anchors(anchor[wanted], sizes), kinds], schema=REPEATED)


def _spread(anchor: np.ndarray, key: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Distinct contents with their anchor and the smallest and largest document."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    if not len(first):
        return (np.zeros(0, np.int64),) * 4
    return anchor[order[first]], key[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in the sorted ``known``, and where."""
    at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
    return (known[at] == values) if len(known) else np.zeros(len(values), bool), at


def _windows(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the segment and first byte of each window of some segments."""
    n = end - start - LEAST + 1
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, start[owner] + np.arange(len(owner)) - (ends - n)[owner]


def _cut_up(data: np.ndarray, found: tuple, hot: np.ndarray):
    """The segments (see ``segments``), those marked hot as one segment for each of their windows."""
    text, start, end, anchor, key = found
    owner, place = _windows(start[hot], end[hot])
    one = np.flatnonzero(hot)[owner]
    keys = Hasher(data).spans(place, place + LEAST).view(np.int64) if len(place) else place
    cold = ~hot
    columns = ((text[cold], text[one]), (start[cold], place), (end[cold], place + LEAST), (anchor[cold], anchor[one]), (key[cold], keys))
    return (*(np.concatenate(c) for c in columns), np.concatenate([np.zeros(int(cold.sum()), bool), np.ones(len(one), bool)]))


def _candidates(buckets: int):
    def cut_out(table: pa.Table, repeated: pa.Table) -> pa.Table:
        """Distinct segments of a part that have a repeated anchor, each with its smallest document.

        The bytes go along only where the anchor has different contents. Where it has too many for
        a bucket (``kind`` 2), each window is a segment of its own, in a bucket of its own hash.
        """
        known = unpacked_anchors(repeated.column("anchors"))[0]
        kind = np.frombuffer(b"".join(repeated.column("kinds").to_pylist()), np.uint8)
        order = np.argsort(known)
        known, kind = known[order], kind[order]
        kept: list[list] = [[], [], [], [], [], []]
        for ids, data, offsets in _texts(table):
            found = segments(data, offsets)
            hit, place = _among(found[3] & ANCHOR_BITS, known)
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            text, start, end, anchor, key, window = _cut_up(data, tuple(x[at] for x in found), kind[place[at]] == 2)
            varied = kind[_among(anchor & ANCHOR_BITS, known)[1]] == 1
            at = np.arange(len(key))
            order = at[np.argsort(key[at])]
            group = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            low, high = np.minimum.reduceat(ids[text[order]], group), np.maximum.reduceat(ids[text[order]], group)
            at = order[group]
            size = np.where(varied[at], end[at] - start[at], 0)
            ends = np.cumsum(size)
            flat = data[np.repeat(start[at] - (ends - size), size) + np.arange(int(ends[-1]))]
            bytes_ = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(flat)])
            for values, new in zip(kept, (anchor[at] & ANCHOR_BITS, key[at], low, high, bytes_, window[at]), strict=True):
                values.append(new)
        if not kept[0]:
            return pa.table([pa.array([], t) for t in SEGMENTS.types], schema=SEGMENTS)
        anchor, key, low, high = (np.concatenate(v) for v in kept[:4])
        order = np.argsort(key, kind="stable")  # a content may be in several steps
        group = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        low, high, at = np.minimum.reduceat(low[order], group), np.maximum.reduceat(high[order], group), order[group]
        content = pa.chunked_array(kept[4]).take(pa.array(at))
        window = np.concatenate(kept[5])[at]
        bucket = (mixed(np.where(window, key[at], anchor[at]).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        part = np.full(len(at), table.column("part")[0].as_py(), np.int32)
        return pa.table([pa.array(bucket), pa.array(part), pa.array(key[at]), pa.array(low), pa.array(low < high), content, pa.array(anchor[at], mask=~window)], schema=SEGMENTS)

    return cut_out


def _matched(table: pa.Table) -> pa.Table:
    """Smallest document of every window of every segment in a bucket, for each part that has it.

    One value stands for all windows of a segment where they agree. Where a part has a segment in
    one document only and that is the smallest for each window, nothing is to be removed there.
    """
    key, doc = np.asarray(table.column("key")), np.asarray(table.column("doc"))
    if not len(key):
        return pa.table([pa.array([], t) for t in ANSWERS.types], schema=ANSWERS)
    order = np.argsort(key, kind="stable")
    group = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    first, smallest = order[group], np.minimum.reduceat(doc[order], group)
    varied = np.flatnonzero(np.asarray(pa.compute.binary_length(table.column("content")))[first] > 0)
    sizes, lowest, values = np.ones(len(first), np.int64), smallest, smallest
    if len(varied):
        contents = table.column("content").take(pa.array(first[varied])).to_numpy().tolist()
        found, count = _shared_windows(contents, smallest[varied], LEAST)
        begin = np.cumsum(count) - count
        low, high = np.minimum.reduceat(found, begin), np.maximum.reduceat(found, begin)
        lowest = smallest.copy()
        lowest[varied] = low
        several = low < high
        sizes[varied[several]] = count[several]
        values = np.repeat(lowest, sizes)
        wide = np.zeros(len(first), bool)
        wide[varied[several]] = True
        values[np.repeat(wide, sizes)] = found[np.repeat(several, count)]
    at = np.empty(len(key), np.int64)
    at[order] = np.repeat(np.arange(len(group)), np.diff(np.append(group, len(key))))
    wanted = np.flatnonzero(np.asarray(table.column("many")) | (lowest[at] < doc))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values)).take(pa.array(at[wanted]))
    give_back()
    return pa.table([table.column("part").take(pa.array(wanted)), table.column("key").take(pa.array(wanted)), lists, table.column("anchor").take(pa.array(wanted))], schema=ANSWERS)


def _removed(with_text: bool, keep: tuple[str, ...]):
    def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
        known = np.asarray(answers.column("key")).astype(np.int64)
        divided = np.unique(np.asarray(answers.column("anchor").drop_null()).astype(np.int64))  # anchors whose windows are answered one by one
        order = np.argsort(known, kind="stable")
        known = known[order]
        lists = answers.column("smallest").combine_chunks().take(pa.array(order))
        values, bounds = np.asarray(lists.flatten()).astype(np.int64), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()).astype(np.int64))])
        rows: dict[str, list] = {n: [] for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text")}
        for ids, data, offsets in _texts(table):
            found = segments(data, offsets)
            hot, _ = _among(found[3] & ANCHOR_BITS, divided)
            text, start, end, _, key = _cut_up(data, found, hot)[:5] if hot.any() else found
            cover = np.zeros(len(data) + 1, np.int32)
            if len(start):
                hit, at = _among(key, known)
                hit = np.flatnonzero(hit)
                n = end[hit] - start[hit] - LEAST + 1
                ends = np.cumsum(n)
                step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)
                single = bounds[at[hit] + 1] - bounds[at[hit]] == 1  # one value for all windows
                smallest = values[np.repeat(bounds[at[hit]], n) + np.where(np.repeat(single, n), 0, step)]
                window = (np.repeat(start[hit], n) + step)[smallest < np.repeat(ids[text[hit]], n)]
                np.add.at(cover, window, 1)
                np.add.at(cover, window + LEAST, -1)
            gone = np.cumsum(cover)[: len(data)] > 0
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            begins = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
            stops = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
            per = np.searchsorted(begins, offsets)
            total = np.concatenate([[0], np.cumsum(gone)])
            for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist(), strict=False)):
                own = data[a:b]
                kept = own[~gone[a:b]] if total[b] > total[a] else own
                rows["kept_sha256"].append(hashlib.sha256(kept.tobytes()).hexdigest())
                spans = [{"start": int(x) - a, "end": int(y) - a} for x, y in zip(begins[per[k] : per[k + 1]], stops[per[k] : per[k + 1]], strict=True)]
                rows["spans"].append(spans)
                if with_text:
                    rows["kept_text"].append(_whole_characters(own.tobytes(), spans))
            rows["doc_id"] += [None if i == NO_ID else i for i in ids.tolist()]
            rows["n_bytes"] += np.diff(offsets).tolist()
            rows["n_removed"] += np.diff(total[offsets]).tolist()
            rows["n_spans"] += np.diff(per).tolist()
        if not with_text:
            rows["kept_text"] = [None] * len(rows["doc_id"])
        found = pa.table(rows, SCHEMA)
        for name in keep:
            found = found.append_column(name, table.column(name))
        return found

    return mark


def _whole_characters(text: bytes, spans: list[dict]) -> str:
    """The text without its spans; a character that a span cuts through stays."""
    kept, at = [], 0
    for s in spans:
        a, b = s["start"], s["end"]
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]).decode("utf-8", "replace")


ANCHORS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("anchors", pa.binary()), ("contents", pa.binary())])
REPEATED = pa.schema([("part", pa.int32()), ("anchors", pa.binary()), ("kinds", pa.binary())])
SEGMENTS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("many", pa.bool_()), ("content", pa.binary()), ("anchor", pa.int64())])
ANSWERS = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("smallest", pa.list_(pa.int64())), ("anchor", pa.int64())])
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_text", pa.string()),
])
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept_text string"


def part_of(parts: int) -> Column:
    """The part of a document, by its id and its text, so that one id doesn't make one part."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The documents with their repeated passages removed, with the columns of ``docs``.

    ``size_col``, if there is one, gets the new number of characters. A null text becomes empty; an
    id keeps its type; other columns, of any name, go along. Null ids, repeated rows and an empty
    table: see ``remove_repeats``.
    """
    frame, (id_col, text_col, *size) = by_place(docs, id_col, text_col, *[c for c in docs.columns if c == size_col])
    others, kinds = tuple(c for c in frame.columns if c not in (id_col, text_col, *size)), dict(frame.dtypes)
    found = remove_repeats(frame, True, id_col, text_col, others)
    new = {id_col: F.col("doc_id").cast(kinds[id_col]), text_col: F.col("kept_text")}
    new |= {c: F.length("kept_text").cast(kinds[c]) for c in size}
    return found.select(*[new.get(c, F.col(f"keep_{c}")) for c in frame.columns]).toDF(*docs.columns)


def remove_repeats(docs: DataFrame, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Remove each byte covered by a 50-byte string that also starts in a document with a smaller id.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end of removed
    runs, in bytes) and, with ``with_text``, kept_text (without the spans, but with characters
    that a span would cut), and the columns named in ``keep``, as keep_<name>. Strings are judged on the input. Null text is empty; null ids count
    as the smallest and as equal to each other; documents with one id, and so repeated rows,
    take nothing from each other. An empty table gives no rows.

    Documents are dealt to parts by their id and text, so that copies spread, and texts of one id
    too; parts are dealt once and read three times: for anchors, for segments, for the removal. A
    passage of any number of documents is one row per part from the first step on. An anchor with
    more than ``ANCHOR_CONTENTS`` contents (a phrase with ever different surroundings) fills no
    bucket: its windows meet by their own hashes.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"keep_{c}") for c in keep])
    carried = plain.columns[2:]
    size = plain.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-size // PART_BYTES))
    dealt = plain.withColumn("part", part_of(parts)).select("part", "doc_id", "text", *carried).repartition("part")
    by_part = dealt.groupBy("part")
    buckets = parts * BUCKETS_PER_PART
    anchors = by_part.applyInArrow(_anchors(buckets), "bucket int, part int, anchors binary, contents binary")
    repeated = anchors.groupBy("bucket").applyInArrow(_repeated, "part int, anchors binary, kinds binary")
    segments_ = by_part.cogroup(repeated.groupBy("part")).applyInArrow(_candidates(buckets), "bucket int, part int, key long, doc long, many boolean, content binary, anchor long")
    answers = segments_.groupBy("bucket").applyInArrow(_matched, "part int, key long, smallest array<long>, anchor long")
    kind = StructType([*StructType.fromDDL(RESULT), *[plain.schema[c] for c in carried]])
    found = by_part.cogroup(answers.groupBy("part")).applyInArrow(_removed(with_text, tuple(carried)), kind)
    return found if with_text else found.drop("kept_text")
