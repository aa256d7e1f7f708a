"""Streaming queries (I3): the micro-batch upsert must equal the batch upsert."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from diamondlake.plans.catalog import register
from diamondlake.plans.warehouse import UPSERT_SQL, _customer_snapshots
from diamondlake.sources.files import shared_path
from diamondlake.sources.tables import load
from diamondlake.streaming.append_stream import stream_append_new
from diamondlake.streaming.upsert_stream import init_snapshot, stream_upsert


@register("stream_upsert", UPSERT_SQL)
def stream_upsert_q(spark, d):
    """The player batch lands as several files; a Structured Streaming query
    (availableNow, one file per micro-batch) upserts each into a versioned
    snapshot.  Result = the batch upsert."""
    target, batch = _customer_snapshots(spark, d)
    root = shared_path(spark, "stream-upsert")
    landing, base, ckpt = (os.path.join(root, x) for x in ("landing", "table", "_checkpoint"))
    # every key comes twice in its file: an outdated row, then the valid one
    old = batch.withColumn("seq", F.lit(0)).withColumn("c_name", F.lit("outdated"))
    batch = old.unionByName(batch.withColumn("seq", F.lit(1)))
    batch.repartition(4, "c_custkey").write.parquet(landing)
    init_snapshot(target, base)
    final = stream_upsert(spark, landing, batch.schema, base, ckpt, ["c_custkey"], ["c_name", "c_acctbal"],
                          source_order=["seq"])
    return spark.read.parquet(final)


@register("stream_append_new", "SELECT * FROM events")
def stream_append_new_q(spark, d):
    """The feed lands in parts that overlap, and a part lands again after a restart; the stream appends
    each event once."""
    ev = load(spark, d, "events")
    root = shared_path(spark, "stream-append")
    landing, table, ckpt = (os.path.join(root, x) for x in ("landing", "table", "_checkpoint"))
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for parts in ([0, 1], [1, 2], [0]):      # three deliveries, each read by a stream of its own on the same checkpoint
        ev.where(third.isin(parts)).write.mode("append").parquet(landing)
        stream_append_new(spark, landing, ev.schema, table, ckpt, ["event_id"])
    return spark.read.schema(ev.schema).parquet(table)
