"""Upsert that rewrites only the files that hold a key of the batch."""

import os

import pytest
from pyspark.sql import functions as F

from diamondlake.operators import pruned_merge as PM


def table(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("n"), (F.col("id") * 2).alias("v"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_files_with_a_key_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    PM.create(table(spark), path, ["k"], files=10)
    before = {n: os.stat(os.path.join(path, n)).st_mtime_ns for n in PM.file_names(spark, path)}
    assert len(before) == 10
    batch = spark.createDataFrame([(5, "x", -1), (7, "y", -2), (2000, "z", -3)], "k long, n string, v long")
    done = PM.merge(spark, path, batch, ["k"], ["v"])
    assert len(done.replaced) == 1 and len(done.kept) == 9 and set(done.kept) | set(done.replaced) == set(before)
    assert {n: os.stat(os.path.join(path, n)).st_mtime_ns for n in done.kept} == {n: before[n] for n in done.kept}
    want = {k: (k, f"n{k}", 2 * k) for k in range(1000)} | {5: (5, "n5", -1), 7: (7, "n7", -2), 2000: (2000, "z", -3)}
    assert rows(PM.read(spark, path)) == sorted(want.values(), key=str)
    assert rows(PM.read(spark, path, 0)) == rows(table(spark))          # the version before is still there
    again = PM.merge(spark, path, batch, ["k"], ["v"])
    assert rows(PM.read(spark, path)) == sorted(want.values(), key=str) and again.version == 2


def test_a_merge_without_its_commit_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    PM.create(table(spark, 20), path, ["k"], files=4)
    os.makedirs(os.path.join(path, "manifest-00000001"))                # begun, no success marker
    assert rows(PM.read(spark, path)) == rows(table(spark, 20))
    batch = spark.createDataFrame([(3, "x", 0)], "k long, n string, v long")
    assert PM.merge(spark, path, batch, ["k"]).version == 2
    assert (3, "x", 0) in rows(PM.read(spark, path))
    with pytest.raises(FileExistsError):
        PM.create(table(spark, 20), path, ["k"])


def test_odd_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (1, None, 2)], "k long, n string, v long")
    PM.create(first, path, ["k"])
    assert PM.merge(spark, path, first.limit(0), ["k"]).version == 0     # nothing to do
    batch = spark.createDataFrame([(None, 9, "u"), (1, 5, "u"), (1, 6, "u")], "k long, v int, extra string")
    PM.merge(spark, path, batch, ["k"], source_order=["v"])
    # a null key matches nothing; the last duplicate counts; other columns stay
    assert rows(PM.read(spark, path)) == sorted([(None, "a", 1), (None, "a", 1), (None, None, 9), (1, None, 6)], key=str)
    empty = str(tmp_path / "e")
    PM.create(first.limit(0), empty, ["k"])
    PM.merge(spark, empty, first, ["k"])
    assert rows(PM.read(spark, empty)) == sorted([(None, "a", 1), (1, None, 2)], key=str)


def test_two_keys_and_pushed_range(spark, tmp_path):
    path = str(tmp_path / "t")
    t = table(spark, 100).withColumn("g", F.col("k") % 10)
    PM.create(t, path, ["g", "k"], files=5)
    batch = spark.createDataFrame([(3, 3, "x", 1), (4, 3, "new", 1)], "g long, k long, n string, v long")
    done = PM.merge(spark, path, batch, ["g", "k"])
    got = {(r["g"], r["k"]): (r["n"], r["v"]) for r in PM.read(spark, path).collect()}
    assert len(got) == 101 and got[(3, 3)] == ("x", 1) and got[(4, 3)] == ("new", 1) and len(done.replaced) == 1
