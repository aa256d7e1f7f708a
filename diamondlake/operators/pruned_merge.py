"""Upsert that rewrites only the files it has to (S6 on large tables).

A table is a folder of Parquet files clustered by key, and a manifest: the list
of files that make it up.  A merge looks for the batch's keys in the key columns
alone, narrowed to the batch's key range (which Parquet's statistics prune by) and
joined to its distinct keys; only files that hold one of them are read whole, joined
once to the batch and written anew.  All other files stay as they are.  The next
manifest, written last, commits the merge: until it has its success marker readers
see the table as before, so a failed merge is simply run again.  One writer at a time."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.operators.upsert import keep_last

MANIFEST = "manifest-"


@dataclass(frozen=True)
class Merged:
    """What a merge did: the new version, and the names of kept, replaced and new files."""

    version: int
    kept: tuple[str, ...]
    replaced: tuple[str, ...]
    added: tuple[str, ...]


def _versions(spark: SparkSession, path: str) -> tuple[list[int], int]:
    """Committed versions, and the number of the next one."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    begun = sorted(int(n.removeprefix(MANIFEST)) for n in names if n.startswith(MANIFEST))
    done = [v for v in begun if fs.exists(jvm.org.apache.hadoop.fs.Path(_manifest(path, v), "_SUCCESS"))]
    return done, begun[-1] + 1 if begun else 0


def _manifest(path: str, version: int) -> str:
    return os.path.join(path, f"{MANIFEST}{version:08d}")


def _write(df: DataFrame, path: str, keys: list[str], files: int | None) -> tuple[str, ...]:
    """Writes ``df`` in files clustered by key; their names below ``path``."""
    name = f"data-{uuid.uuid4().hex}"
    spread = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    spread.sortWithinPartitions(*keys).write.parquet(os.path.join(path, name))
    written = df.sparkSession.read.schema(df.schema).parquet(os.path.join(path, name)).inputFiles()
    return tuple(sorted(f"{name}/{f.rsplit('/', 1)[-1]}" for f in written))


def _commit(spark: SparkSession, path: str, version: int, names: tuple[str, ...]) -> None:
    spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.parquet(_manifest(path, version))


def create(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """A new table at ``path`` (version 0), in ``files`` files or as many as AQE makes of the data."""
    if _versions(df.sparkSession, path)[1]:
        raise FileExistsError(f"{path} holds a table")
    _commit(df.sparkSession, path, 0, _write(df, path, keys, files))


def file_names(spark: SparkSession, path: str, version: int | None = None) -> tuple[str, ...]:
    """Names of the files of a version (default: the last); as many as the table has files."""
    done, _ = _versions(spark, path)
    if not done or version is not None and version not in done:
        raise FileNotFoundError(f"no committed version {'' if version is None else version} at {path}")
    rows = spark.read.parquet(_manifest(path, done[-1] if version is None else version)).collect()
    return tuple(sorted(r["name"] for r in rows))


def _read(spark: SparkSession, path: str, names: tuple[str, ...], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*(os.path.join(path, n) for n in names))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at ``path``; earlier versions can be read as long as their files stay."""
    return spark.read.parquet(*(os.path.join(path, n) for n in file_names(spark, path, version)))


def files_with_keys(table: DataFrame, batch: DataFrame, keys: list[str]) -> tuple[str, ...]:
    """Names of the files of ``table`` that hold a key of ``batch``. Reads key
    columns only; row groups outside the batch's key range are skipped."""
    wanted = batch.select(*keys).dropna().distinct()
    bounds = wanted.agg(*(f(k).alias(f"{f.__name__}_{i}") for i, k in enumerate(keys) for f in (F.min, F.max))).first()
    if bounds["min_0"] is None:
        return ()
    near = table.select(*keys, F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -2, 2)).alias("__file"))
    for i, k in enumerate(keys):
        near = near.where(F.col(k).between(F.lit(bounds[f"min_{i}"]), F.lit(bounds[f"max_{i}"])))
    found = near.join(wanted, keys, "left_semi").groupBy("__file").agg(F.lit(1)).collect()  # at most one row a file
    return tuple(sorted(r["__file"] for r in found))


def merge(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], update_cols: list[str] | None = None,
          source_order: list[str] | None = None, files: int | None = None) -> Merged:
    """Insert the batch's new keys with all columns it has; on key conflict
    overwrite ``update_cols`` (default: all it has) and keep the other columns.

    A key that the batch holds more than once keeps its last row by
    ``source_order`` (default: all other columns, so a retry keeps the same row).
    A key with a null matches nothing: such rows of the table stay, those of
    the batch are inserted once per null key.  An empty batch commits nothing.  The batch
    is read three times; write it down first if it is costly."""
    old = file_names(spark, path)
    table = read(spark, path)
    schema, rest = table.schema, [c for c in batch.columns if c not in keys and c in table.columns]
    batch = keep_last(batch, keys, source_order or rest, rest) if rest else batch.select(*keys).distinct()
    if batch.isEmpty():
        return Merged(_versions(spark, path)[0][-1], old, (), ())
    hit = files_with_keys(table, batch, keys)
    update = set(rest if update_cols is None else update_cols) & set(rest)
    ours = (_read(spark, path, hit, schema) if hit else table.limit(0)).withColumn("__ours", F.lit(True)).alias("t")
    theirs = batch.withColumn("__theirs", F.lit(True)).alias("b")
    both = ours.join(theirs, [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    there, here = F.col("__ours").isNotNull(), F.col("__theirs").isNotNull()

    def value(c: str):
        if c in keys:
            return F.when(there, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}"))
        if c not in rest:
            return F.col(f"t.{c}")
        take = here if c in update else here & ~there
        return F.when(take, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))

    out = both.select(*(value(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
    added = _write(out, path, keys, files)
    kept = tuple(n for n in old if n not in set(hit))
    version = _versions(spark, path)[1]
    _commit(spark, path, version, tuple(sorted((*kept, *added))))
    return Merged(version, kept, hit, added)
