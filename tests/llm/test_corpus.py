"""Corpus operators against brute force, on texts with nulls, ties, copies, long and empty rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import language, minhash, mixing, neighbours, packing, quality, sharding, suffixes, tokenfiles, tokens, toxicity
from reviewloom.llm.components import components
from reviewloom.llm.tokens import PieceEncoder, default_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, row string, part int"


def sentence(rng, n, words="alpha beta gamma delta naïve Zeta, eta. theta iota kappa lambda mu".split()):
    return " ".join(rng.choice(words) + (str(rng.randint(0, 99)) if rng.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(5, 120)) for _ in range(30)]
    passage = sentence(rng, 30)
    rows = [*base, *base[:6], base[0] + " more", *[f"{sentence(rng, 40)} {passage} {sentence(rng, 20)}" for _ in range(5)]]
    rows += [None, "", "  \n ", "a", "a b", "A B", "x\n\nx\nx", "ü" * 80, "ü" * 81, sentence(rng, 9_000), "  two  spaces ", "<|endoftext|> \x01 z"]
    return list(enumerate(rows, 3))


@pytest.fixture(scope="module")
def docs(spark, texts):
    langs = ["en", "fr", None]
    rows = [(i, t, langs[i % 3], None if i % 5 == 0 else f"s{i % 3}", len(t or ""), 1, "x", "y", 2) for i, t in texts]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def odd(spark):
    """A null id, repeated rows, and one id with two texts."""
    return spark.createDataFrame([(None, "one two three four", "en", "a")] + [(7, "one two three four", "en", "a")] * 3 + [(7, None, None, None), (9, "", "en", "a")], "doc_id long, text string, lang string, source string")


def test_shards_are_even_and_slots_have_no_gaps(docs, texts, odd, empty):
    rows = sharding.assign_shards(docs, 4).collect()
    by = {i: t or "" for i, t in texts}
    assert all(r.text_crc32 == zlib.crc32(by[r.doc_id].encode()) and r.size == len(by[r.doc_id].encode()) + 8 for r in rows)
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    for shard in {r.shard for r in rows}:
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 4) <= largest + 1
    assert sharding.assign_shards(odd, 2).count() == 6
    assert sharding.assign_shards(empty, 4).count() == 0


def test_one_repeated_row_is_spread_over_shards(spark):
    same = spark.range(4_000).select(F.lit(1).alias("doc_id"), F.lit("copy").alias("text"))
    counts = sharding.assign_shards(same, 8).groupBy("shard").count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) - min(r["count"] for r in counts) <= 2


def test_overfull_ranges_are_subdivided(spark):
    text = F.when(F.col("id") % 4 == 0, "copy").otherwise(F.concat(F.lit("text "), F.col("id")))
    rows = sharding.keyed_rows(spark.range(12_000).select(F.lit(None).cast("long").alias("doc_id"), text.alias("text")).repartition(6))
    whole = rows.agg(F.sum("size").alias("b")).first().b
    bounds, filled = sharding.splitters(rows, 12_000, whole, 64)
    assert sum(n for n, _ in filled) == 12_000 and len(filled) == len(bounds) + 1
    assert max(n for n, _ in filled) <= 3 * 12_000 / 64


def test_written_shards_hold_every_document(docs, tmp_path, spark):
    sharding.write_shards(docs.drop("shard"), sharding.assign_shards(docs, 3), str(tmp_path / "shards"))
    found = spark.read.parquet(str(tmp_path / "shards"))
    assert found.count() == docs.count() and found.select("shard").distinct().count() == 3


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else ({tuple(words)} if words else set())


def test_near_duplicates_match_all_pairs(docs, texts, odd, empty):
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = minhash.near_duplicates(docs).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}
    assert minhash.near_duplicates(odd).count() == 6
    assert minhash.one_per_group(odd).count() == 3
    assert minhash.near_duplicates(empty).count() == minhash.one_per_group(empty).count() == 0
    kept = minhash.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == sum(find(i) == i for i in sets)


@pytest.mark.parametrize("length", [1_024, 2_048])
def test_self_similar_words_are_told_apart(spark, length):
    bits = [bin(i).count("1") % 2 for i in range(length)]
    words = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    docs = spark.createDataFrame([(i, f"x y {w}") for i, w in enumerate(words)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {0: 0, 1: 1}


def test_word_hashes_of_blocks_and_long_words(monkeypatch):
    texts = [" ".join("ab" * (k % 9 + 1) for k in range(300)), "q" * 5_000, "Q" * 5_000, "", "ab abab"]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    whole, counts = minhash.word_hashes(data, offsets)
    monkeypatch.setattr(minhash, "_KEPT_POWERS", 64)
    assert (minhash.word_hashes(data, offsets)[0] == whole).all() and counts.tolist() == [300, 1, 1, 0, 2]
    assert whole[300] == whole[301] and whole[0] == whole[302] and len(set(whole.tolist())) == 10


def test_width_and_percent_are_parameters(spark):
    words = [f"w{i}" for i in range(100)]
    near = [*words[:98], "x", "y"]  # 94 of 98 five-word shingles are shared
    far = [w if i % 20 else "z" for i, w in enumerate(words)]
    rows = [(i, " ".join(t)) for i, t in enumerate([words, near, far, words[:4], words[:4]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, percent=80, width=5).collect()}
    assert found == {0: (96, 0), 1: (96, 0), 2: (96, 2), 3: (1, 3), 4: (1, 3)}
    assert {r.doc_id for r in minhash.one_per_group(docs, percent=80, width=5).collect()} == {0, 2, 3}


def test_unrelated_texts_without_an_id_or_with_one_id_all_stay(spark):
    words = [[f"{c}{i}" for i in range(60)] for c in "pqrstu"]
    first = [*words[0][:58], "x", "y"]  # near words[0]
    rows = [(None, words[0]), (None, first), (None, words[1]), (None, words[1]), (None, words[2]), (4, words[3]), (4, words[4]), (4, words[4]), (5, words[5]), (None, words[5]), (None, []), (4, [])]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    kept = Counter((r.doc_id, r.text[:1]) for r in minhash.one_per_group(table).collect())
    assert kept == Counter([(None, "p"), (None, "q"), (None, "r"), (4, "s"), (4, "t"), (5, "u"), (None, ""), (4, "")])
    assert minhash.near_duplicates(table).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_repeated_rows_give_a_class_one_text(spark):
    members = spark.createDataFrame([(0, 10), (1, 10), (0, 11), (1, 11)], "cls long, band long")
    classes = spark.createDataFrame([(0, 7, 70), (1, minhash.NO_ID, 80), (2, 9, 90)], "cls long, rep_id long, rep_key long")
    rows = [(7, 70, "a b c")] * 20 + [(minhash.NO_ID, 80, "a b d")] * 30 + [(7, 71, "other"), (9, 90, "alone")]
    texts = minhash._texts_of(members, classes, spark.createDataFrame(rows, "doc_id long, text_key long, text string").repartition(3))
    assert sorted(map(tuple, texts.collect())) == [(0, "a b c"), (1, "a b d")]


def test_sketches_keep_every_similar_pair():
    rng = np.random.default_rng(4)
    for n in (3, 40, 200, 256, 257, 3_000):
        one = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        others = []
        for part in (1.0, 0.93, 0.5):  # shared part of both sets; 0.93 is a similarity of 0.87
            shared = int(np.ceil(len(one) * part))
            others.append(np.unique(np.concatenate([one[:shared], rng.integers(0, 1 << 63, n - shared).astype(np.uint64)])))
        excess = minhash.sketch_excess(minhash.read_sketch(minhash.sketch(one)), [minhash.read_sketch(minhash.sketch(x)) for x in others], 0.85)
        assert excess[0] >= 0 and excess[1] >= 0 and excess[2] < 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 99)], "a long, b long")
    found = dict(components(links).collect())
    assert all(found[i] == 0 for i in range(41)) and {found[99], found[100], found[101]} == {99}


def repeats(texts):
    seen, out = {}, {}
    for i, t in texts:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            seen[b[p : p + 50]] = min(i, seen.get(b[p : p + 50], i))
    for i, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        gone = gone[: len(b)]
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def test_repeated_passages_match_all_windows(docs, texts, odd, empty):
    rows = suffixes.remove_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == repeats(texts)
    assert suffixes.remove_repeats(odd).count() == 6 and suffixes.remove_repeats(empty).count() == 0
    kept = suffixes.without_repeats(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert "�" not in "".join(r.text for r in kept.collect())


def test_long_runs_of_one_anchor_are_several_segments(spark):
    rows = [(1, "a" * 900 + "b" * 70), (2, "b" * 60 + "a" * 2_000), (3, "xyz" * 400), (4, "c" + "xyz" * 500), (5, "ab" * 30 + "a" * 51)]
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == repeats(rows)
    data = np.frombuffer(rows[1][1].encode(), np.uint8)
    _, start, end, _, _ = suffixes.segments(data, np.array([0, len(data)]))
    assert (end - start).max() < suffixes.LEAST + suffixes.SEGMENT_WINDOWS and (end - start - 49).sum() == len(data) - 49


def test_stages_keep_columns_of_any_name(spark):
    text = "one two three four five six seven"
    rows = [(1, f"{text} eight", "en", "s", 39, 1, 2, "t", 4), (2, f"{text} nine ten", "fr", "s", 42, 3, 4, None, 5)]
    names = ["doc_id", "text", "lang", "source", "n_chars", "a.b", "my col", "Text", "c1"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, x int, y int, z string, c1 int").toDF(*names)
    stages = [
        lambda d: language.keep_identified(d, language.train(d)), lambda d: minhash.one_per_group(d, 80, width=5),
        suffixes.without_repeats, lambda d: mixing.mixed_documents(d, mixing.mix(d)),
    ]
    for stage in stages:
        found = stage(docs)
        assert found.columns == names and {tuple(r) for r in found.collect()} <= set(rows)


def test_an_anchor_with_many_contents_fills_no_bucket(spark, monkeypatch):
    rng = random.Random(8)
    phrase = "the same phrase of thirty bytes"
    rows = [(i, f"{sentence(rng, 12)} {phrase} {sentence(rng, 12)}") for i in range(300)]
    rows += [(300 + i, rows[i][1][20:-9]) for i in range(20)]
    monkeypatch.setattr(suffixes, "ANCHOR_CONTENTS", 20)
    monkeypatch.setattr(suffixes, "PART_BYTES", 8 << 10)
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == repeats(rows)
    part = pa.table({"part": pa.array([0] * 300, pa.int32()), "doc_id": pa.array(range(300)), "text": [t for _, t in rows[:300]]})
    anchors = suffixes._anchors(64)(part)
    names = suffixes.unpacked_anchors(anchors["anchors"])[0]
    counts = suffixes.from_planes(anchors["contents"])[0] >> np.uint64(suffixes.COUNT_SHIFT)
    assert len(np.unique(names)) == len(names) and anchors.num_rows == len(set(anchors["bucket"].to_pylist()))
    kinds = pa.array([np.where(counts > 20, 2, 1).astype(np.uint8).tobytes()])
    all_names = suffixes.packed_anchors(np.sort(names.view(np.uint64)).view(np.int64), np.array([len(names)]))
    made = suffixes._candidates(1024)(part, pa.table({"anchors": pa.chunked_array([all_names]), "kinds": kinds})).to_pandas()
    own = made[made["content"].str.len() > 0].groupby("bucket").size()
    windows = made[made["anchor"].notna()]
    assert counts.max() > 40 and windows["bucket"].nunique() > 20 and own.max() <= 20
    assert made["content"].str.len().gt(0).sum() + len(windows) == len(made)


def test_anchors_are_packed_without_loss():
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.integers(0, 1 << 48, n).astype(np.uint64)) << np.uint64(16) for n in (0, 1, 700, 0, 3)]
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).view(np.int64)
    found, counted = suffixes.unpacked_anchors(pa.chunked_array([suffixes.packed_anchors(flat, sizes)]))
    assert (found == flat).all() and (counted == sizes).all()
    values = rng.integers(0, 1 << 63, len(flat)).astype(np.uint64)
    assert (suffixes.from_planes(pa.chunked_array([suffixes.to_planes(values, sizes)]))[0] == values).all()


def test_texts_of_one_id_are_dealt_to_all_parts(spark):
    texts = spark.range(2_000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    counts = [r["count"] for r in texts.select(suffixes.part_of(4).alias("part")).groupBy("part").count().collect()]
    assert len(counts) == 4 and max(counts) < 700


def test_shared_windows_of_near_equal_contents():
    rng = random.Random(3)
    contents = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(5, 40))) for _ in range(60)})
    owners = np.array([rng.randint(0, 20) for _ in contents])
    least = {}
    for c, o in zip(contents, owners.tolist(), strict=True):
        for p in range(len(c) - 4):
            least[c[p : p + 5]] = min(o, least.get(c[p : p + 5], o))
    for c, found in zip(contents, suffixes.shared_windows(contents, owners, 5), strict=True):
        assert found.tolist() == [least[c[p : p + 5]] for p in range(len(c) - 4)]


def test_intervals_grow_without_a_sort_for_each_length(monkeypatch):
    """Common prefixes below the limit are exact, with one sort for the transform and few for the suffixes."""
    rng = random.Random(4)
    text = np.frombuffer(b"\xff".join(bytes(rng.choice(b"ab") for _ in range(rng.randint(30, 300))) for _ in range(40)) + b"\xff", np.uint8)
    sorts, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **b: sorts.append(1) or sort(*a, **b))
    order = suffixes.suffix_order(text, 50)
    assert len(sorts) <= 3
    levels = suffixes.common_prefix_levels(text[order - 1], 50)
    assert len(sorts) <= 4
    plain = text.tobytes()
    for k in range(1, len(order)):
        a, b = (plain[x : x + 50].split(b"\xff")[0] for x in order[k - 1 : k + 1].tolist())
        if len(a) == len(b) == 50:
            same = next((i for i in range(50) if a[i] != b[i]), -1)
            assert levels[k] == same


@pytest.mark.parametrize(("name", "split"), [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")])
def test_pieces_encode_like_whole_texts(texts, name, split):
    import pyarrow as pa

    encoder = PieceEncoder(default_path(name), split)
    values = [t for _, t in texts]
    ids, offsets = encoder.encode(pa.array(values, pa.string()))
    for t, a, b in zip(values, offsets, offsets[1:], strict=False):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_few_texts_are_encoded_in_one_call():
    """Texts with other spaces are encoded whole; the tokenizer's results for them must not be held all at once."""

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.calls = tokenizer, []

        def encode_batch_fast(self, some, **options):
            self.calls.append(len(some))
            return self.tokenizer.encode_batch_fast(some, **options)

    encoder = PieceEncoder(default_path("byte_bpe_50k.json"), "spaces")
    values = [f"whole{i}  text\n\n {i}  " if i % 2 else f"first{i} ünd {i}" for i in range(200)]
    plain, encoder.tokenizer = encoder.tokenizer, Counted(encoder.tokenizer)
    ids, offsets = encoder.encode(pa.array(values, pa.string()))
    for t, a, b in zip(values, offsets, offsets[1:], strict=False):
        assert ids[a:b].tolist() == plain.encode(t, add_special_tokens=False).ids
    assert max(encoder.tokenizer.calls) <= tokens.TEXTS


def test_packing_fills_sequences_without_gaps(docs, odd, empty):
    packed = packing.pack(packing.tokenized_pieces(docs, capacity=256, with_ids=True), 256)
    rows = packed.collect()
    for k in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == k), key=lambda r: r.offset):
            assert r.offset == at and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at <= 256
    assert {r.sequence_id: len(r.ids) for r in packing.sequences(packed).collect()} == dict(Counter({k: sum(r.length for r in rows if r.sequence_id == k) for k in {r.sequence_id for r in rows}}))
    for i in {r.doc_id for r in rows}:
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.length for r in own[1:]] == [256] * (len(own) - 1) and own[0].start == 0
    assert packing.pack(packing.tokenized_pieces(odd)).count() == 6
    assert packing.pack(packing.tokenized_pieces(empty)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_matching_places_every_item_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 20): rng.randint(1, 50) for _ in range(rng.randint(1, 60))}
    ranks, bins = {}, {}
    for length, rank, n, first, per, offset in packing.matched_runs(counts, 20):
        ranks.setdefault(length, []).extend(range(rank, rank + n))
        for i in range(n):
            bins.setdefault(first + i // per, []).append((offset + i % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 20 and sum(3 * length > 20 for _, length in items) <= 2


def test_rules_match_plain_counts(docs, texts, odd, empty):
    rows = {r.doc_id: r for r in quality.quality(docs).collect()}
    for i, t in texts:
        words, seen, dup = WORD.findall(t or ""), set(), 0
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        covered = {p for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for p in range(k, k + 5)}
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        r = rows[i]
        symbols = sum(c in quality.SYMBOLS for c in t or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), symbols, dup, len(covered))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words)) and not (r.base_failed and r.kept)
    assert quality.quality(odd).count() == 6 and quality.quality(empty).count() == 0


def test_rule_order_does_not_change_the_verdict(docs):
    rules = quality.default_rules()
    counted = quality.base_counts(docs)
    one, two = (counted.select("doc_id", quality.cascade(r).isNull().alias("ok")) for r in (rules, rules[::-1]))
    assert sorted(one.collect()) == sorted(two.collect())


def test_languages_are_told_apart_and_spans_switch(spark, odd, empty):
    rng = random.Random(1)
    english, russian, french = "the and with house water".split(), "дом вода и это слово".split(), "le être avec maison où".split()
    rows = [(i, sentence(rng, 20, words), lang) for i, (words, lang) in enumerate([(english, "en"), (russian, "ru"), (french, "fr")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    tested = spark.createDataFrame([(1, "the house and the water with the house"), (2, "это дом"), (3, "12 !?"), (4, None), (5, " ".join(english * 5 + french * 5)), (6, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in language.identify(tested, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, 6)] == ["en", "ru", "und", "und", "und"]
    assert [s.lang for s in found[5].spans] == ["en", "fr"] and found[4].score == 0 and 0 <= found[5].score <= 1
    assert language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(tested, language.train(empty)).collect()} == {"und"}
    assert language.keep_identified(odd, language.train(odd)).columns == odd.columns


def test_texts_of_many_languages_stay_and_noise_goes(spark, empty):
    rng = random.Random(2)
    words = {"en": "the and with house water".split(), "fr": "être avec maison où leurs".split(), "de": "und nicht straße wasser über".split(), "es": "señor pero muchos donde años".split()}
    docs = spark.createDataFrame([(i, sentence(rng, 20, w), lang) for i, (lang, w) in enumerate([*words.items()] * 20)], "doc_id long, text string, lang string")
    mixed = " ".join(" ".join(rng.choice(w) for _ in range(30)) for w in words.values())
    noise = " ".join("".join(rng.choice("bcdfgjkmpqvxyz") for _ in range(6)) for _ in range(40))
    tested = spark.createDataFrame([(1, "the house and the water with the house"), (2, mixed), (3, noise), (4, "12 !?"), (5, None), (6, "")], "doc_id long, text string")
    assert {r.doc_id for r in language.keep_identified(tested, language.train(docs)).collect()} == {1, 2}
    assert {r.doc_id for r in language.keep_identified(tested, language.train(empty)).collect()} == {1, 2, 3}


def test_neighbours_reach_recall_and_skip_bad_vectors(spark, empty):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1_500, 24))
    x[700:1200] = x[3]  # copies
    rows = [(i, [float(v) for v in row], "e") for i, row in enumerate(x)]
    rows += [(5_000, None, "e"), (5_050, [0.0] * 24, "e"), (5_100, [float("nan")] * 24, "e"), (5_150, [1.0, None] * 12, "e"), rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    found = {}
    for r in neighbours.search(table, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r.query_id, []).append(r)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 1_500, 50):
        own = sorted(found[q], key=lambda r: r.rank)
        score = unit @ unit[q]
        score[q] = -2
        best = np.lexsort((np.arange(1_500), -np.round(score, 12)))[:5]
        assert [r.rank for r in own] == [1, 2, 3, 4, 5] and np.allclose([r.score for r in own], score[[r.vec_id for r in own]])
        hit += len({r.vec_id for r in own} & set(best.tolist()))
    assert set(found) == set(range(0, 1_500, 50)) and hit / 150 >= 0.9
    assert neighbours.search(table.limit(0), F.lit(True)).count() == 0
    few = neighbours.search(table.where("vec_id < 3"), F.lit(True)).collect()
    assert len(few) == 6


def test_neighbours_that_tie_are_the_smallest_ids(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-3, 4, 16).astype(float)
    base[0] = 1.0
    ids = rng.permutation(60).tolist()  # ids don't follow the order of the rows
    rows = [(i, [float(x) for x in base * 2.0**n]) for n, i in enumerate(ids)]
    rows += [(100 + i, [float(x) for x in rng.normal(size=16)]) for i in range(40)]
    for parts in (1, 5):
        found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts), F.col("vec_id").isin(0, 3, 50)).collect()
        by = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 3, 50)}
        assert by == {0: [1, 2, 3, 4, 5], 3: [0, 1, 2, 4, 5], 50: [0, 1, 2, 3, 4]}


def test_targets_stop_at_twice_a_size():
    sizes = [100, 100, 100, 10]
    targets = mixing.source_targets(sizes)
    assert sum(targets) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * s for t, s in zip(targets, sizes, strict=True))
    assert targets[0] == 200 and targets[3] == 20 and targets[1] == pytest.approx(2 * targets[2])


def test_flight_keeps_count_and_size():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 500, 400)
    done = mixing.flight(np.full(400, 0.37), sizes, 1, False)
    assert ((done > 0) & (done < 1)).sum() <= 2
    assert done.sum() == pytest.approx(148) and (done * sizes).sum() == pytest.approx(0.37 * sizes.sum())


def test_equal_rows_are_counted_and_share_their_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "REPEAT_BLOCK", 50)
    hot = spark.range(3_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("hot").alias("source"), (F.col("id") % 7).alias("n_chars"))
    rest = spark.range(900).select("id", F.concat(F.lit("w "), F.col("id")), F.lit("rest"), F.lit(0).cast("long"))
    docs = hot.union(rest)
    drawn = mixing.mix(docs, chunk=200)
    per = {r.source: r for r in drawn.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n"), F.sum("copies").alias("copies")).collect()}
    assert per["hot"].n == 3_000 and per["rest"].n == 900
    assert all(abs(r.taken - r.target) <= 6 for r in per.values())
    made = mixing.mixed_documents(docs, drawn)
    counts = {r.source: r["count"] for r in made.groupBy("source").count().collect()}
    assert counts == {k: r.copies for k, r in per.items()}
    base, rows = divmod(per["hot"].copies, 3_000)
    of = {r.n_chars: r["count"] for r in made.where("source = 'hot'").groupBy("n_chars").count().collect()}
    own = {r.n_chars: r["count"] for r in hot.groupBy("n_chars").count().collect()}
    assert all(base * own[k] <= n <= (base + 1) * own[k] for k, n in of.items())
    numbers = mixing.numbered(spark.createDataFrame([("a", 120), ("b", 3), ("c", 0)], "k string, n long"), "n", "i").collect()
    assert sorted((r.k, r.i) for r in numbers) == [("a", i) for i in range(120)] + [("b", i) for i in range(3)]


def test_language_is_learned_without_ids(spark):
    words = {"en": "the house and water are here with some people".split(), "fr": "la maison et l'eau sont ici avec des gens".split()}
    rng = random.Random(2)
    rows = [(lang, " ".join(rng.choice(w) for _ in range(40)) + f" {i}") for i in range(100) for lang, w in words.items()]
    for doc_id in ("null", "5", "id"):
        docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "id long, text string, lang string")
        docs = docs.selectExpr(f"cast({doc_id} as long) as doc_id", "text", "lang")
        model = language.train(docs, per_language=20)
        found = language.identify(docs, model).collect()
        assert model.langs == ["en", "fr"] and {r.lang_pred for r in found} == {"en", "fr"}
        assert language.keep_identified(docs, model).count() == 200
    nothing = language.train(docs, per_language=0)
    assert nothing.langs == [] and language.keep_identified(docs, nothing).count() == 200
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}


def test_mix_comes_near_its_targets(docs, spark, odd, empty):
    many = docs.withColumn("text", F.coalesce("text", F.lit(""))).crossJoin(spark.range(12)).withColumn("doc_id", F.col("doc_id") * 100 + F.col("id")).drop("id")
    drawn = mixing.mix(many, chunk=40).collect()
    assert len(drawn) == many.count() and all(r.taken == r.copies * r.size and r.copies in (0, 1, 2) for r in drawn)
    for source in {r.source for r in drawn}:
        own = [r for r in drawn if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.05 * own[0].target
    assert sorted(mixing.mix(many.repartition(7), chunk=40).select("doc_id", "taken").collect()) == sorted((r.doc_id, r.taken) for r in drawn)
    assert mixing.mix(odd).count() == 6 and mixing.mix(empty).count() == 0
    made = mixing.mixed_documents(many, mixing.mix(many))
    assert made.columns == many.columns and made.count() == mixing.mix(many).agg(F.sum("copies")).first()[0]


def test_token_files_round_trip(docs, texts, tmp_path, odd, empty):
    path = default_path("word_bpe_49k.json")
    manifest = tokenfiles.write_token_files(docs, f"file://{tmp_path}/ids")
    tokenizer, start = PieceEncoder(path, "words").tokenizer, 0
    found = {r.doc_id: r for r in tokenfiles.read_token_files(manifest).collect()}
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert [x.tolist() for x in tokenfiles.FrameReader(r.path).document(i)] == [ids.tolist()]
        start += len(ids)
    assert tokenfiles.token_files(odd).count() == 6 and tokenfiles.token_files(empty).count() == 0


def test_damaged_frames_are_noticed(docs, tmp_path):
    manifest = tokenfiles.write_token_files(docs, f"file://{tmp_path}/ids").collect()
    place = manifest[0].path.removeprefix("file://")
    data = bytearray(open(place, "rb").read())
    data[40] ^= 0xFF
    open(place, "wb").write(data)
    with pytest.raises(Exception):  # noqa: B017
        tokenfiles.FrameReader(manifest[0].path).frame(0)


def test_toxicity_learns_marked_words(spark, odd, empty):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        text, toxic = sentence(rng, 40), int(i % 4 == 0)
        rows.append((i, text + " you idiot fool idiotic" * 2 if toxic else text))
        labels.append((i, toxic))
    rows += [(900, None), (901, ""), (902, "you 1diot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels[:300] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs, known).collect()}
    assert len(found) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    assert all(found[i].predicted == toxic for i, toxic in labels[300:])
    assert toxicity.score(odd, known.limit(0)).count() == 6
    assert toxicity.score(empty, known).count() == 0


def test_pipeline_runs_on_every_stage(docs, spark, tmp_path):
    import corpus_pipeline

    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, current, str(tmp_path))
        assert out.columns == current.columns and out.count() <= 2 * current.count()


def test_quality_counts_without_regular_expressions(spark):
    """Words, letters and symbols of texts with every white space, long runs of it, and characters of several bytes."""
    import re

    texts = ["", " ", "\t\n\x0b\x0c\r ", "a", " a\x0bb\x0c\x0cc\r\nd  e\t", "#*$%&|<>", "é# ü $$  x 😀%\x1fy\u0085z", "<p>" * 40 + "\n\n", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counted = quality.base_counts(docs)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and "[\\x20\\x09-\\x0D]+" not in plan
    for row in counted.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id] or "")
        assert (row.n_words, row.word_chars) == (len(words), sum(map(len, words)))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in texts[row.doc_id] or "")


def test_quality_sorts_repeated_windows_once(spark):
    docs = spark.createDataFrame([(0, "a b c d e f " * 4), (1, "a b c d e x a b c d e"), (2, " ".join(map(str, range(50))))], "doc_id long, text string")
    counted = quality.base_counts(docs)
    assert {r.doc_id: r.n_repeat_words for r in counted.collect()} == {0: 24, 1: 10, 2: 0}
    # A condition copies the expression below the counts; the sort must not be copied within it.
    plan = counted.select("doc_id", "n_repeat_words")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(transform(") == 2 and "array_sort(" not in plan
    assert counted.where("NOT base_failed").count() == 1
