"""Token ids of whole texts: the tokenizer encodes each distinct piece once, numpy puts texts together."""

from __future__ import annotations

import os
import sys
import types
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces that a worker remembers. This bounds memory; a piece not remembered is encoded again.
REMEMBERED = 600_000
#: Pieces that are encoded as one text.
TOGETHER = 64
#: Texts in one call; the tokenizer's results take far more memory than the ids.
TEXTS = 16
MARK = "\x01"
BLANK = {chr(c) for c in range(0x3001) if chr(c).isspace()}


def default_path(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memory:
    """Pieces and their ids: piece number ``k`` has ``sizes[k]`` ids from ``begins[k]`` on."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.begins, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def with_new(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and sizes with new pieces after the remembered ones."""
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        return np.concatenate([self.ids, ids]), np.concatenate([self.begins, begins]), np.concatenate([self.sizes, sizes])


def _of_worker(key: str, make):
    """A value that lives as long as the Python worker, for all its tasks."""
    home = sys.modules.setdefault("reviewloom_worker_memory", types.ModuleType("reviewloom_worker_memory"))
    if key not in home.__dict__:
        home.__dict__[key] = make()
    return home.__dict__[key]


@dataclass
class _Loaded:
    """A tokenizer with what its split needs, and the pieces it has encoded."""

    tokenizer: Tokenizer
    starts: np.ndarray  # ids whose token begins with a space
    mark: int
    known: _Memory


def _load(path: str, split: str) -> _Loaded:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    if split == "words":
        mark = tokenizer.encode(MARK, add_special_tokens=False).ids
        assert len(mark) == 1, "the mark must be one token"
        return _Loaded(tokenizer, np.zeros(0, bool), mark[0], _Memory())
    first = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
    starts = np.array([bool(t) and t[0] == "Ġ" for t in first])  # how byte-level BPE writes a space
    return _Loaded(tokenizer, starts, -1, _Memory())


class PieceEncoder:
    """Encodes texts piece by piece, with the tokenizer's own result.

    ``split`` says where texts may be divided without changing ids:

    * "words": at ASCII white space, for tokenizers that drop white space and lower the case;
    * "spaces": before a single space that a non-space follows, for byte-level BPE, where a space
      belongs to what follows. Texts with other spaces are encoded whole.

    The tokenizer is loaded once for each Python worker.
    """

    def __init__(self, path: str, split: str):
        loaded = _of_worker(f"{split} {path}", lambda: _load(path, split))
        self.split, self.tokenizer, self.known = split, loaded.tokenizer, loaded.known
        self.starts, self.mark = loaded.starts, loaded.mark

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = []
        for i in range(0, len(texts), TEXTS):
            found += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[i : i + TEXTS], add_special_tokens=False)]
        return found

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another and their numbers, many encoded as one text and divided again."""
        flat, sizes = [], []
        groups = [pieces[i : i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
        for i in range(0, len(groups), TEXTS):
            some = groups[i : i + TEXTS]
            if self.split == "words":
                texts = [f" {MARK} ".join(g) for g in some]
            else:
                texts = ["".join([f" {p}" for p in g]) for g in some]
            for group, ids in zip(some, self._encode(texts), strict=True):
                if self.split == "words":
                    marks = ids == self.mark
                    reach = np.concatenate([[-1], np.flatnonzero(marks), [len(ids)]])
                    count, ids = np.diff(reach) - 1, ids[~marks]
                else:
                    count = np.diff(np.append(np.flatnonzero(self.starts[ids]), len(ids)))
                assert len(count) == len(group), "a piece was divided in another place"
                flat.append(ids)
                sizes.append(count)
        return (np.concatenate(flat), np.concatenate(sizes)) if flat else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _numbered(self, pieces: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The number of each piece, and ids, begins and sizes by number; new pieces are encoded."""
        known, numbers = self.known, self.known.numbers
        at = np.fromiter(map(numbers.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at, (known.ids, known.begins, known.sizes)
        plain = [pieces[i] for i in missing.tolist()]
        if self.split == "words":
            marked = np.array([MARK in p for p in plain])
            if marked.any():  # can't be divided by the mark, so these are encoded by themselves
                missing = np.concatenate([missing[~marked], missing[marked]])
                alone = self._encode([p for p in plain if MARK in p])
                plain = [p for p in plain if MARK not in p]
                ids, sizes = self._learn(plain)
                ids, sizes = np.concatenate([ids, *alone]), np.concatenate([sizes, [len(x) for x in alone]])
                plain = [pieces[i] for i in missing.tolist()]
            else:
                ids, sizes = self._learn(plain)
        else:
            ids, sizes = self._learn(plain)
        store = known.with_new(ids, sizes)
        at[missing] = np.arange(len(known.sizes), len(store[2]))
        if len(store[2]) > REMEMBERED:
            known.clear()
        else:
            numbers.update(zip(plain, at[missing].tolist(), strict=True))
            known.ids, known.begins, known.sizes = store
        return at, store

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the n + 1 offsets of the texts; null is empty."""
        if texts.null_count:
            texts = texts.fill_null("")
        if self.split == "words":
            lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        else:
            lists = pc.split_pattern(texts, " ")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        ends = np.asarray(lists.offsets).astype(np.int64)
        ends = ends - ends[0]
        coded = lists.flatten().dictionary_encode()
        index = np.asarray(coded.indices).astype(np.int64)
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each first
        whole: dict[int, np.ndarray] = {}
        if self.split == "words" or not len(index):
            at, (ids, begins, sizes) = self._numbered(pieces)
            return _assembled(ids, begins[at], sizes[at], index, ends, whole)
        first = ends[:-1][np.diff(ends) > 0]
        blank = np.array([not p or p[0] in BLANK for p in pieces])
        unsafe = blank[index]
        unsafe[first] = False
        docs = np.unique(np.searchsorted(ends, np.flatnonzero(unsafe), "right") - 1)
        if len(docs):
            whole = dict(zip(docs.tolist(), self._encode(texts.take(pa.array(docs)).to_pylist()), strict=True))
        used = np.zeros(len(pieces), bool)
        inner = np.ones(len(index), bool)
        inner[first] = False
        used[index[inner]] = True
        safe = np.flatnonzero(used & ~blank)
        at, (ids, begins, sizes) = self._numbered([pieces[i] for i in safe.tolist()])
        begin, size = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        begin[safe], size[safe] = begins[at], sizes[at]
        # A text's first piece has no space before it.
        kinds, opening = np.unique(index[first], return_inverse=True)
        alone = self._encode([pieces[i] for i in kinds.tolist()])
        own = np.array([len(x) for x in alone], np.int64)
        index = index.copy()
        index[first] = len(pieces) + opening
        begin, size = np.concatenate([begin, len(ids) + np.cumsum(own) - own]), np.concatenate([size, own])
        return _assembled(np.concatenate([ids, *alone]), begin, size, index, ends, whole)


def _assembled(ids: np.ndarray, begin: np.ndarray, size: np.ndarray, index: np.ndarray, ends: np.ndarray, whole: dict[int, np.ndarray]):
    """Ids of each text from the ids of its pieces; ``whole`` has texts that were encoded as they are."""
    count = size[index]
    reach = np.concatenate([[0], np.cumsum(count)])
    flat = ids[np.repeat(begin[index] - reach[:-1], count) + np.arange(int(reach[-1]))]
    offsets = reach[ends]
    if not whole:
        return flat, offsets
    parts = [whole.get(k, flat[offsets[k] : offsets[k + 1]]) for k in range(len(ends) - 1)]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
