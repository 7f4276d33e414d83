"""JSON arrays that many splits read together."""

import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reviewloom.sources import json_arrays


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, value in before.items():
        spark.conf.set(n, value)


def value(rng, depth=0):
    kind = rng.randint(0, 9)
    text = "".join(rng.choice(['a', '"', "\\", "{", "}", "[", "]", ",", ":", "é", "\n", " ", "\\\\", "\\\"", "漢"]) for _ in range(rng.randint(0, 30)))
    if depth < 3 and kind < 3:
        return {f"k{i}{rng.choice(['', '}', chr(34), ','])}": value(rng, depth + 1) for i in range(rng.randint(0, 4))}
    if depth < 3 and kind < 5:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return text if kind < 8 else rng.choice([None, True, 7, -1.5, [], {}])


def elements(spark, path):
    rows = json_arrays.read_elements(spark, str(path)).orderBy("number").collect()
    assert [r.number for r in rows] == list(range(len(rows)))
    return [json.loads(r.text) for r in rows]


@pytest.mark.parametrize("size", [40, 300, 5_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_every_split_size_gives_the_same_elements(spark, tmp_path, small_splits, size, indent):
    rng = random.Random(size)
    records = [value(rng) for _ in range(150)]
    path = tmp_path / "export.json"
    path.write_text(" \n" + json.dumps(records, indent=indent, ensure_ascii=False) + "\n  ", encoding="utf-8")
    small_splits(size)
    reader = spark.read.option("lineSep", "}").text(str(path))
    assert reader.rdd.getNumPartitions() >= min(8, path.stat().st_size // size)
    assert elements(spark, path) == records


def test_steps_and_splits_by_shuffle(spark, tmp_path, small_splits, monkeypatch):
    rng = random.Random(9)
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text(json.dumps([value(rng) for _ in range(80)]), encoding="utf-8")
    small_splits(500)
    expected = sorted(json.dumps(v) for f in tmp_path.iterdir() for v in json.loads(f.read_text()))
    for limit, step in ((0, 1 << 20), (200_000, 16), (0, 64)):
        monkeypatch.setattr(json_arrays, "BROADCAST_SPLITS", limit)
        monkeypatch.setattr(json_arrays, "STEP_BYTES", step)
        found = json_arrays.read_elements(spark, str(tmp_path)).collect()
        assert sorted(json.dumps(json.loads(r.text)) for r in found) == expected


def test_an_element_may_be_longer_than_many_splits(spark, tmp_path, small_splits):
    records = [1, {"text": "}{,\"" * 3_000, "more": [{"a": i} for i in range(500)]}, {"b": 2}]
    path = tmp_path / "long.json"
    path.write_text(json.dumps(records))
    small_splits(200)
    assert elements(spark, path) == records


def test_variants_are_those_of_whole_files(spark, tmp_path, small_splits):
    rng = random.Random(4)
    path = tmp_path / "a b.json"
    path.write_text(json.dumps([{"v": value(rng)} for _ in range(60)]))
    small_splits(400)
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "d").json(str(path))
    expected = whole.select(F.explode(F.expr("cast(d as array<variant>)")).alias("raw")).select(F.to_json("raw").alias("j"))
    found = json_arrays.read_arrays(spark, str(path))
    assert sorted(r.j for r in found.select(F.to_json("raw").alias("j")).collect()) == sorted(r.j for r in expected.collect())
    assert found.select("path").distinct().collect()[0][0].endswith("a%20b.json")


@pytest.mark.parametrize("text", ["[]", " [ \n] ", ""])
def test_empty_arrays_have_no_elements(spark, tmp_path, text):
    (tmp_path / "e.json").write_text(text)
    assert json_arrays.read_arrays(spark, str(tmp_path / "e.json")).collect() == []


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ('{"reviews": [1]}', "top-level JSON list"), ("7", "top-level JSON list"), ("[1] 2", "top-level JSON list"), ("[1][2]", "top-level JSON list"),
        ('["a', "isn't closed"), ("[1, 2", "isn't closed"), ("[1, ", "isn't closed"), ('[{"a": 1}', "isn't closed"), ("[1}", "top-level JSON list|isn't closed"),
        ("[1,]", "MALFORMED"), ("[,1]", "MALFORMED"), ('[{"a": ]', "top-level JSON list|isn't closed|MALFORMED"), ("[nope]", "MALFORMED"),
    ],
)
def test_damaged_arrays_are_errors(spark, tmp_path, small_splits, text, message):
    (tmp_path / "d.json").write_text(text)
    for size in (3, 10_000):
        small_splits(size)
        with pytest.raises((PySparkException, Py4JJavaError), match=message):
            json_arrays.read_arrays(spark, str(tmp_path / "d.json")).collect()
