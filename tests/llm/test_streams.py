"""Fill-in-middle, concatenate-and-cut and vector codes against plain code."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewloom.llm import codes, middles, windows
from reviewloom.llm.tokens import default_path

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
KIND = "doc_id long, text string, n long, form string, ids string, `a.b` int, `my col` int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = ["".join(rng.choice(["ab", "Z", "é", " ", "\n", "漢", "1", "𝒳", "<", "qrs", "<P", "S>"]) for _ in range(rng.randint(0, 400))) for _ in range(150)]
    odd = [(None, "a b c d"), (None, None), (7, "same id"), (7, "other text"), (8, ""), (9, "x<P>y"), (10, "<S>"), (11, "z" * 5_000), (12, "é1 " * 400_000)]
    return [*enumerate(texts, 1_000), *odd, *odd[2:4], *[(-5, "repeated row here")] * 3]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 2, 3) for i, t in rows], KIND).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def cut_plainly(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles_match_plain_cuts_and_are_restored(docs, rows, empty):
    found = middles.fill_in_middle(docs).withColumn("back", middles.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1], r[1:])
    expected = sorted(((i, *((f := cut_plainly(i, t))[:2]), f[4], t or "") for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.n, r.form, r.output, r.back) for r in found), key=key) == expected
    widths = {(r.doc_id, r.output): (r.prefix_chars, r.middle_chars) for r in found}
    assert all(widths[i, f[4]] == f[2:4] for i, t in rows for f in [cut_plainly(i, t)])
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert middles.fill_in_middle(empty).collect() == []


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_skip_lists_reach_every_rank(monkeypatch, window):
    monkeypatch.setattr(middles, "WINDOW_BYTES", window)
    texts = ["", "abc def", "", "é漢𝒳 a" * 40, "q" * 300, "1", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    lists = middles.SkipLists(data, np.cumsum([0, *[len(t.encode()) for t in texts]]))
    assert lists.n_units.tolist() == [len(UNIT.findall(t)) for t in texts]
    assert lists.n_codes.tolist() == [len(t) for t in texts]
    wanted = [(k, r) for k, t in enumerate(texts) for r in range(len(UNIT.findall(t)) + 1) if t]
    at, units = lists.descend(*(np.array(x) for x in zip(*wanted, strict=True)))
    for (k, rank), code, unit in zip(wanted, at.tolist(), units.tolist(), strict=True):
        assert unit <= rank and lists.cut(texts[k], code, unit, rank) == len("".join(UNIT.findall(texts[k])[:rank]))


def test_express_lanes_skip_most_of_a_long_text():
    data = np.frombuffer(b"1" * 300_000, np.uint8)
    lists = middles.SkipLists(data, np.array([0, len(data)]))
    ranks = np.arange(0, 300_000, 997)
    codes_, units = lists.descend(np.zeros(len(ranks), np.int64), ranks)
    assert (codes_ == units).all() and (ranks - units).mean() < 20 and sum(map(len, lists.unit_width)) < 300_000 / 6


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_stream_is_cut_into_full_windows(docs, rows, tokenizer, empty):
    pieces = windows.concatenate_and_cut(docs, capacity=64, with_ids=True).cache()
    found = pieces.collect()
    by_window = defaultdict(list)
    for r in found:
        assert 0 < r.length <= 64 and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_window[r.sequence_id].append(r)
    total = sum(r.length for r in found)
    assert sorted(by_window) == list(range(-(-total // 64)))
    for number, own in by_window.items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == (64 if number < len(by_window) - 1 else (total - 1) % 64 + 1)
    # In the order of the stream every text comes whole, one after another.
    texts, left = [], 0
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        if not left:
            texts.append((r.doc_id, []))
            left = r.doc_tokens
        assert r.start == len(texts[-1][1]) and r.doc_id == texts[-1][0]
        texts[-1][1].extend(r.ids)
        left -= r.length
    assert left == 0
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    whole = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    assert sorted(texts, key=key) == sorted(whole, key=key)
    put_together = {r.sequence_id: r.ids for r in windows.sequences(pieces, 64).collect()}
    assert put_together == {n: [x for r in own for x in r.ids] for n, own in by_window.items()}
    assert windows.concatenate_and_cut(empty).collect() == []


def test_totals_of_many_parts_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(windows, "TOTALS_BLOCK", 4)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', int(id % 17))").alias("text")).repartition(23)
    found = windows.concatenate_and_cut(docs, capacity=32).select(F.expr("sequence_id * 32 + offset").alias("at"), "length").orderBy("at").collect()
    assert [r.at for r in found] == np.cumsum([0, *[r.length for r in found][:-1]]).tolist()


def lloyd(rows, positions, entries, rounds):
    """Codes, errors and codebooks by plain whole numbers; rows are (id, vector, label)."""
    kept = [(i, [*map(float, v)], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max(len(v) for _, v, _ in kept)
    w = -(-longest // positions)
    ints = [[math.floor(1024 * x) for x in v] + [0] * (w * positions - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    parts = lambda v: [v[p * w : (p + 1) * w] for p in range(positions)]
    books = [[parts(ints[k])[p] for k in order] for p in range(positions)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for v in ints:
                groups[near(parts(v)[p], book)[0]].append(parts(v)[p])
            for e, members in groups.items():
                book[e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, by_label = [], defaultdict(int)
    for (i, _, label), v in zip(kept, ints, strict=True):
        pairs = [near(x, books[p]) for p, x in enumerate(parts(v))]
        found.append((i, label, "".join(f"{a:02x}" for a, _ in pairs), sum(d for _, d in pairs)))
        by_label[label] += found[-1][3]
    return sorted(((i, code, error, by_label[label], digest) for i, label, code, error in found), key=str)


NAMES = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
VECTORS = "vec_id long, embedding array<float>, label int, key string, part int, `a.b` int"


def coded(df, **options):
    return sorted((tuple(r[n] for n in NAMES) for r in codes.compress(df, **options).collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    rows = [(int(i), [float(np.float32(x)) for x in centers[i % 12] + rng.normal(size=8) * 0.2], int(i % 5) if i % 7 else None) for i in range(260)]
    rows += [rows[3]] * 60  # a repeated row
    rows += [(None, rows[9][1], 1), (500, None, 1), (501, [1.0, None] * 4, 2), (502, [float("nan")] * 8, 3), (503, [float("inf")] + [0.0] * 7, 3)]
    return rows + [(600, [0.5, 0.25, -1.0], 4), (601, [], 4), (2, rows[20][1], 0)]


def test_codes_match_plain_lloyd(spark, vectors, monkeypatch):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in vectors], VECTORS).repartition(6)
    expected = lloyd(vectors, 4, 16, 4)
    assert coded(df, entries=16) == expected
    monkeypatch.setattr(codes, "STEP", 64)  # many steps
    assert coded(df.repartition(1), entries=16) == expected


def test_full_entries_are_divided_and_sums_stay(spark, vectors):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in vectors], VECTORS)
    rows = codes.usable(df)
    same = [codes.train(rows, 8, 4, 16, 3, cell_rows=c).sha256() for c in (10, 1_000)]
    assert same[0] == same[1]


def test_few_no_large_and_unlabelled_vectors(spark):
    few = [(2, [1.0, 2.0, 3.0, 4.5], 1), (1, [1.0, 2.0, 3.0, 4.0], None), (1, [0.0, -0.001, 9.0, 1.0], None)]
    rest = ("x", 1, 2)
    assert coded(spark.createDataFrame([(*r, *rest) for r in few], VECTORS)) == lloyd(few, 4, 256, 4)
    large = [(i, [30_000.0 * ((-1) ** (i + k)) + i for k in range(4)], 1) for i in range(9)]
    assert coded(spark.createDataFrame([(*r, *rest) for r in large], VECTORS), entries=3) == lloyd(large, 4, 3, 4)
    assert codes.compress(spark.createDataFrame([(1, [3e38] * 4, 1, *rest)], VECTORS)).collect()[0].error == 0
    assert codes.compress(spark.createDataFrame([], VECTORS)).collect() == []
    assert coded(spark.createDataFrame([(5, [], 1, *rest)], VECTORS))[0][:4] == (5, "00000000", 0, 0)
    bare = spark.createDataFrame([(1, [1.0] * 4)], "vec_id long, embedding array<double>")
    assert [r.label_error for r in codes.compress(bare).collect()] == [0]
