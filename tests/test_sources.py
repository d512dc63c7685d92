"""Published generations and files of any size: worked cases."""

import os
import random

import pytest
from pyspark.sql import functions as F

from termwright.sources import published, readers


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/store"


def rows(spark, *values):
    return spark.createDataFrame([*values], "k string, v int")


def test_generations_keep_unchanged_parts(spark, root):
    one = published.publish(root, {"t": rows(spark, ("a", 1), ("a", 2), ("b", 3), (None, 4)), "s": rows(spark, ("x", 1))}, {"t": "k"})
    two = published.publish(root, {"t": rows(spark, (None, 4), ("b", 9), ("a", 2), ("a", 1), ("c", 5)).repartition(3)}, {"t": "k"})
    assert (one.number, two.number) == (1, 2) and two.tables["s"] == one.tables["s"]
    kept = {k for k, p in two.tables["t"]["parts"].items() if p == one.tables["t"]["parts"].get(k)}
    assert len(two.tables["t"]["parts"]) == 4 and len(kept) == 2
    got = sorted((r.k or "", r.v) for r in published.read_published(spark, root, "t").collect())
    assert got == [("", 4), ("a", 1), ("a", 2), ("b", 9), ("c", 5)] and published.read_published(spark, root, "t").columns == ["k", "v"]
    # Two equal rows are not one, and do not cancel.
    three = published.publish(root, {"t": rows(spark, ("b", 9), ("b", 9), ("b", 9))}, {"t": "k"})
    assert published.read_published(spark, root, "t").count() == 3 and len(three.tables["t"]["parts"]) == 1


def test_a_failed_write_leaves_the_old_generation(spark, root):
    published.publish(root, {"a": rows(spark, ("x", 1)), "b": rows(spark, ("y", 2))})
    broken = rows(spark, ("z", 3)).withColumn("v", F.expr("cast(raise_error('no') as int)"))
    with pytest.raises(Exception):
        published.publish(root, {"a": rows(spark, ("new", 1)), "b": broken})
    assert published.manifest(spark, root).number == 1
    assert [r.k for r in published.read_published(spark, root, "a").collect()] == ["x"]
    # What the failed write has left, and what is old, goes.
    published.publish(root, {"a": rows(spark, ("x", 2))})
    published.publish(root, {"a": rows(spark, ("x", 3))})
    assert published.swept(spark, root, keep=1) >= 3
    assert [r.v for r in published.read_published(spark, root, "a").collect()] == [3] and published.read_published(spark, root, "b").count() == 1


def test_two_writers(spark, root):
    published.publish(root, {"a": rows(spark, ("x", 1))})
    with pytest.raises(RuntimeError):
        published._commit(spark, root, published.Manifest(1, {}))
    assert published.manifest(spark, root).tables and published.read_published(spark, root, "a").count() == 1


def test_empty_and_unknown_tables(spark, root):
    published.publish(root, {"a": rows(spark).limit(0)})
    assert published.read_published(spark, root, "a").count() == 0
    with pytest.raises(KeyError):
        published.read_published(spark, root, "none")


def test_files_of_any_size(spark, tmp_path):
    rng = random.Random(7)
    texts = {"end.txt": "a\n" * 60_000, "open.md": "xé中\r\n\n" * 20_000 + "last", "one.txt": "z" * 90_000, "small.txt": "s\n", "empty.txt": "", "bad.txt": "", "skip.bin": "b" * 90_000}
    texts["mixed.txt"] = "".join(rng.choice(("é", "中", "\n", "ab", "\n\n", "\r")) for _ in range(90_000))
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    (tmp_path / "bad.txt").write_bytes(b"\xff\n" * 50_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        pieces = readers.read_file_ranges(spark, str(tmp_path), above=50_000)
        assert pieces.where("path like '%mixed.txt'").count() > 5
        got = {os.path.basename(r.path): r for r in readers.read_corpus_files(spark, str(tmp_path), at_once=50_000).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == ["bad.txt", "end.txt", "mixed.txt", "one.txt", "open.md", "small.txt"]
    assert all(got[n].text == texts[n] and got[n].size == len(texts[n].encode()) for n in got if n != "bad.txt")
    assert got["bad.txt"].text == "�\n" * 50_000
    less = {os.path.basename(r.path) for r in readers.read_corpus_files(spark, str(tmp_path), at_once=50_000, most=100_000).collect()}
    assert less == {"bad.txt", "one.txt", "small.txt"}
    sources = [{"path": str(tmp_path), "collection": "c"}, {"path": str(tmp_path), "collection": "d", "most": 100_000}]
    assert readers.read_manifest(spark, sources).groupBy("collection").count().orderBy("collection").collect() == [("c", 6), ("d", 3)]
    skips = {r.collection: r.files for r in readers.manifest_skips(spark, sources).collect()}
    assert skips == {"c": 0, "d": 3}
