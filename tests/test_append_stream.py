"""Keyed state across files, restarts and the time keys are remembered."""

import os

from diamondlake.streaming.append_stream import STORE, stream_append_new

KIND = "id long, v string"


def _land(spark, path, rows, name, day):
    spark.createDataFrame(rows, KIND).coalesce(1).write.parquet(os.path.join(path, "_tmp", name))
    part = next(f for f in os.listdir(os.path.join(path, "_tmp", name)) if f.endswith(".parquet"))
    at = os.path.join(path, "landing", f"{name}.parquet")
    os.makedirs(os.path.dirname(at), exist_ok=True)
    os.link(os.path.join(path, "_tmp", name, part), at)
    os.utime(at, (1_700_000_000 + day * 86400,) * 2)


def _run(spark, path, **more):
    table = os.path.join(path, "table")
    stream_append_new(spark, os.path.join(path, "landing"), KIND, table, os.path.join(path, "checkpoint"), ["id"], files_per_trigger=1, **more)
    return sorted(((r["id"], r["v"]) for r in spark.read.schema(KIND).parquet(table).collect()), key=str)


def test_keys_are_known_across_files_and_restarts(spark, tmp_path):
    p = str(tmp_path)
    _land(spark, p, [(1, "a"), (2, "b"), (2, "b"), (None, "n")], "f1", 0)
    _land(spark, p, [(2, "late"), (3, "c")], "f2", 1)
    assert _run(spark, p) == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]
    _land(spark, p, [(1, "again"), (None, "again"), (4, "d")], "f3", 2)      # a new stream on the same checkpoint
    assert _run(spark, p) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (None, "n")]
    assert _run(spark, p) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (None, "n")]      # nothing new has landed


def test_keys_are_forgotten_after_their_time_but_new_ones_never_lost(spark, tmp_path):
    p = str(tmp_path)
    _land(spark, p, [(1, "a")], "f1", 0)
    _land(spark, p, [(2, "b")], "f2", 40)
    _land(spark, p, [(3, "c")], "f3", 41)
    _land(spark, p, [(1, "much later"), (3, "c again")], "f4", 42)
    assert _run(spark, p, remember="7 days") == [(1, "a"), (1, "much later"), (2, "b"), (3, "c")]


def test_the_session_keeps_its_own_store(spark, tmp_path):
    before = spark.conf.get(STORE, None)
    _land(spark, str(tmp_path), [(1, "a")], "f1", 0)
    _run(spark, str(tmp_path))
    assert spark.conf.get(STORE, None) == before
