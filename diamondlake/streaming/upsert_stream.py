"""Streaming upsert (I3): landed batch files -> per micro-batch upsert into a
versioned snapshot table.

Each micro-batch writes a new snapshot version named after its batch id and
only then becomes the current one; a batch replayed after a failure rewrites
the same version from the same input, so the sink is idempotent and the
stream's checkpoint (in the shared checkpoint dir) gives exactly-once
results."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from diamondlake.operators.upsert import upsert_by_key


def _versions(spark: SparkSession, base: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(
                os.path.join(base, name, "_SUCCESS"))):
            out.append(int(name[1:]))
    return sorted(out)


def _any_order(batch: DataFrame, keys: list[str]) -> list[str] | None:
    """Order for duplicate keys when none is given: all other columns, so that a replay keeps the same row."""
    return [c for c in batch.columns if c not in keys] or None


def current_snapshot(spark: SparkSession, base: str) -> str:
    v = _versions(spark, base)
    if not v:
        raise FileNotFoundError(f"no committed snapshot under {base}")
    return os.path.join(base, f"v{v[-1]}")


def init_snapshot(df: DataFrame, base: str) -> str:
    """Version 0 = the initial table."""
    path = os.path.join(base, "v0")
    df.write.mode("overwrite").parquet(path)
    return path


def upsert_snapshot(spark: SparkSession, base: str, batch: DataFrame, keys: list[str],
                    update_cols: list[str] | None = None, version: int | None = None,
                    source_order: list[str] | None = None) -> str:
    """S6 as a batch job: merge ``batch`` into the latest committed snapshot
    below ``version`` and write the result as snapshot ``version`` (default:
    next).  Readers keep using the previous snapshot until the new one has its
    ``_SUCCESS`` marker; rerunning the same version rewrites it identically."""
    committed = _versions(spark, base)
    version = version if version is not None else (committed[-1] + 1 if committed else 1)
    prior = [v for v in committed if v < version]
    target = spark.read.parquet(os.path.join(base, f"v{prior[-1]}"))
    merged = upsert_by_key(target, batch, keys, update_cols, source_order or _any_order(batch, keys))
    path = os.path.join(base, f"v{version}")
    merged.write.mode("overwrite").parquet(path)
    return path


def stream_upsert(spark: SparkSession, landing: str, schema, base: str, checkpoint: str, keys: list[str],
                  update_cols: list[str] | None = None, files_per_trigger: int = 1,
                  source_order: list[str] | None = None) -> str:
    """Run the landing-folder stream to completion (``availableNow``) and return
    the path of the final snapshot.  A key that a micro-batch holds more than once
    keeps its last row by ``source_order``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_snapshot(spark, base, batch, keys, update_cols, batch_id + 1, source_order)

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
         .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return current_snapshot(spark, base)


def stream_upsert_partitioned(spark: SparkSession, landing: str, schema, table: str, checkpoint: str,
                              keys: list[str], partition_col: str, update_cols: list[str] | None = None,
                              files_per_trigger: int = 1, source_order: list[str] | None = None) -> str:
    """Streaming upsert into a table partitioned by ``partition_col`` (e.g.
    season) that rewrites only the partitions a micro-batch touches.

    Per micro-batch: the touched partition values are read with partition
    pruning, merged with the batch, staged in the shared checkpoint dir and
    written back with dynamic partition overwrite, so untouched partitions
    are not read or rewritten.  The upsert is idempotent, so a micro-batch
    replayed after a failure (same batch id, same input) converges to the same
    table.  ``partition_col`` must be part of ``keys`` (a key never moves
    between partitions)."""
    if partition_col not in keys:
        raise ValueError("partition_col must be one of the keys")
    from pyspark.sql import functions as F
    from diamondlake.sources.files import cut_lineage_to, shared_path

    def apply(batch: DataFrame, batch_id: int) -> None:
        touched = [r[0] for r in batch.select(partition_col).distinct().collect()]   # bounded: partition values
        current = spark.read.parquet(table).filter(F.col(partition_col).isin(touched))
        rows = batch.select(*current.columns, *(c for c in source_order or () if c not in current.columns))
        merged = upsert_by_key(current, rows, keys, update_cols, source_order or _any_order(rows, keys))
        staged = cut_lineage_to(merged, shared_path(spark, f"upsert-stage-{batch_id}"))
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(table))

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
         .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table
