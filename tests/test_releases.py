import hashlib
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reviewloom.schemas import TABLES, table_schema
from reviewloom.sources import manifest, releases
from reviewloom.sources.raw_json import ReviewSource
from reviewloom.sources.tables import write_table


def made(spark, name, count):
    """Topics or rules that tell which run they are from by their number."""
    if name == "topics":
        return spark.createDataFrame([(i, ["t"], [1.0]) for i in range(count)], table_schema(name))
    return spark.createDataFrame([(["a"], ["b"], 0.1, 0.5, float(i)) for i in range(count)], table_schema(name))


def both(spark, count):
    return {name: made(spark, name, count) for name in ("topics", "association_rules")}


def sizes(tables):
    return tables["topics"].count(), tables["association_rules"].count()


def test_a_run_that_fails_between_two_tables_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path)
    assert sizes(releases.read_release(spark, root)) == (0, 0)
    assert releases.write_release(spark, root, both(spark, 2)) == 1
    broken = made(spark, "association_rules", 5).withColumn("lift", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(PySparkException):
        releases.write_release(spark, root, {"topics": made(spark, "topics", 5), "association_rules": broken})
    assert len(os.listdir(tmp_path / "runs")) == 2
    assert sizes(releases.read_release(spark, root)) == (2, 2)
    assert releases.releases(spark, root).count() == 1
    assert releases.write_release(spark, root, both(spark, 5)) == 2
    assert sizes(releases.read_release(spark, root)) == (5, 5)


def test_open_tables_and_numbered_releases(spark, tmp_path):
    root = str(tmp_path)
    releases.write_release(spark, root, both(spark, 1))
    opened = releases.read_release(spark, root)
    releases.write_release(spark, root, both(spark, 2))
    releases.write_release(spark, root, both(spark, 3))
    assert sizes(opened) == (1, 1)
    assert sizes(releases.read_release(spark, root, 2)) == (2, 2)
    assert [r["number"] for r in releases.releases(spark, root).collect()] == [3, 2, 1]
    (gone,) = releases.expire(spark, root)
    assert not os.path.exists(f"{root}/{gone}")
    assert sizes(releases.read_release(spark, root)) == (3, 3) and sizes(releases.read_release(spark, root, 2)) == (2, 2)
    with pytest.raises(ValueError, match="no release 9"):
        releases.read_release(spark, root, 9)
    with pytest.raises(ValueError, match="must be kept"):
        releases.expire(spark, root, 0)


def test_runs_of_one_number_have_one_winner(spark, tmp_path):
    root = str(tmp_path)
    runs = []
    for count in (1, 2):
        runs.append((f"runs/{'ab'[count - 1]}", count))
        for name, table in both(spark, count).items():
            write_table(table, f"{root}/{runs[-1][0]}", name)
    assert [releases.publish(spark, root, run) for run, _ in runs] == [1, 2]
    # Another publisher that also saw no release before.
    late = spark.range(1).select(F.lit(2).cast("bigint").alias("number"), F.lit("runs/a").alias("run"), F.current_timestamp().alias("published_at"))
    late.coalesce(1).write.mode("append").json(f"{root}/releases")
    assert releases.releases(spark, root).first()["run"] == "runs/b"
    assert sizes(releases.read_release(spark, root)) == (2, 2)


def test_tables_made_from_tables_of_the_run(spark, tmp_path):
    from reviewloom.sources.tables import read_table

    def rules(folder):
        topics = read_table(spark, folder, "topics", required=True)
        return made(spark, "association_rules", 9).limit(topics.count())

    releases.write_release(spark, str(tmp_path), {"topics": made(spark, "topics", 4), "association_rules": rules})
    found = releases.read_release(spark, str(tmp_path))
    assert sizes(found) == (4, 4) and set(found) == set(TABLES)


# -- digests -----------------------------------------------------------------


def test_digests_of_large_packed_and_empty_files(spark, tmp_path, rows):
    contents = {
        "some chunks.json": os.urandom(manifest.CHUNK_BYTES * 2 + 3),
        "packed+1.json.gz": b"\x1f\x8b" + os.urandom(50),
        "empty.json": b"",
        "one%20chunk.json": os.urandom(manifest.CHUNK_BYTES),
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in rows(manifest.file_digests(spark, str(tmp_path)))}
    assert found == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items() if c}
    whole = manifest.file_digests(spark, str(tmp_path), chunked=())
    assert {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in rows(whole)} == found


def test_digest_of_a_file_above_two_gigabytes(spark, tmp_path):
    size, path = (1 << 31) + 5, tmp_path / "sparse.json"
    path.touch()
    os.truncate(path, size)
    expected = hashlib.sha256()
    for first in range(0, size, 1 << 24):
        expected.update(bytes(min(1 << 24, size - first)))
    (found,) = manifest.file_digests(spark, str(path)).collect()
    assert (found["size_bytes"], found["sha256"]) == (size, expected.hexdigest())


def test_manifest_as_tables(spark, tmp_path, rows):
    for i in range(3):
        (tmp_path / f"part {i}.json").write_text("x" * (i + 1))
    source = ReviewSource(str(tmp_path), "b", "B")
    reviews = spark.createDataFrame([("b", "part 1.json"), ("b", None)], "branch_id string, raw_source_file string")
    found = manifest.manifest_tables(spark, [source], reviews)
    files = sorted(rows(found["source_files"]), key=lambda r: r["file_name"])
    assert [(f["file_name"], f["size_bytes"], f["branch_id"]) for f in files] == [(f"part {i}.json", i + 1, "b") for i in range(3)]
    assert found["records_by_branch"].count() == 1 and found["records_by_source_file"].count() == 2
