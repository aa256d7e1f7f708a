"""Streaming append of new keys (I1 as a stream, I3): landed files -> rows whose
key hasn't come before -> table.

The keys seen live in keyed state across micro-batches (RocksDB, with its
changes in the stream's checkpoint), so a key delivered again in a later file or
after a restart is recognised without reading the table. Keys are forgotten
``remember`` after the landing time of their file, which bounds the state; time
is the landing time, not a time inside the row, so an old row that lands for
the first time is never too late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LANDED = "__landed"


def new_rows(stream: DataFrame, keys: list[str], landed: str = LANDED, remember: str = "14 days") -> DataFrame:
    """The first row of each key (NULL is a key like any other); ``landed`` is when the row's file landed. Of equal
    keys in one micro-batch any one row stays, so rows that may differ under one key need an upsert instead."""
    return stream.withWatermark(landed, remember).dropDuplicatesWithinWatermark(keys)


def stream_append_new(spark: SparkSession, landing: str, schema, table: str, checkpoint: str, keys: list[str],
                      remember: str = "14 days", files_per_trigger: int = 100) -> int:
    """Run the landing folder's stream until its files are read (``availableNow``) and return the number of micro-batches.
    The sink commits each micro-batch once, so a restart neither loses nor repeats rows."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
                .select("*", F.col("_metadata.file_modification_time").alias(LANDED)))
        q = (new_rows(rows, keys, LANDED, remember).drop(LANDED).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).option("path", table).trigger(availableNow=True).start())
        q.awaitTermination()
        return (q.lastProgress["batchId"] + 1) if q.lastProgress else 0
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
