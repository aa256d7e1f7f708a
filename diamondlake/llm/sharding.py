"""Shard placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized
table (an offset and a step from its name's hash, so the order is a
permutation). Shards take turns claiming the next slot of theirs that is free
until the table is full: each shard gets an equal share of the slots to within
one, and when the set of shards changes, few slots change hands. The
table has a fixed size, whatever the data's; it is broadcast, and a row finds
its shard in constant time by its key's hash."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

#: Slots (a prime) and shards of the production set-up.
SLOTS, SHARDS = 65_537, 256


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot."""
    if not is_prime(slots) or not 0 < len(shards) <= slots:
        raise ValueError("the number of slots must be a prime, and not below the number of shards")
    if len(set(shards)) < len(shards):
        raise ValueError("shard names repeat")
    order = []
    for name in shards:
        h = hashlib.md5(name.encode()).digest()
        order.append([int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:], "big") % (slots - 1) + 1 if slots > 2 else 1])
    table, free = [-1] * slots, slots
    while free:
        for k, at in enumerate(order):
            while table[at[0]] >= 0:
                at[0] = (at[0] + at[1]) % slots
            table[at[0]] = k
            free -= 1
            if not free:
                break
    return table


def lookup(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard) rows of the filled table; its size is fixed by the set-up, not by the data."""
    slots = F.posexplode(F.split(F.lit(",".join(map(str, table))), ","))
    return spark.range(1).select(slots.alias("slot", "shard")).select(F.col("slot").cast("long"), F.col("shard").cast("int"))


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a string key: the first 60 bits of its MD5, mod the table's size."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long") % slots


def place(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: list[str] | int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with two more columns, ``slot`` (long) and ``shard`` (int). If
    ``docs`` has columns of these names, they are replaced.

    The key is the id, so repeated rows and copies meet in one shard; rows
    without an id go by their text's hash, and rows with neither by the empty
    key. An empty table gives no rows. No shuffle."""
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    slot, shard = fresh(docs, "slot", "shard")
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col).cast("binary")), F.lit(""))
    table = F.broadcast(lookup(docs.sparkSession, fill_table(names, slots)).toDF(slot, shard))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("slot", "shard")]
    return docs.withColumn(slot, slot_of(key, slots)).join(table, slot).select(*kept, F.col(slot).alias("slot"), F.col(shard).alias("shard"))


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Writes one folder per shard; a shard's rows are spread over
    ``files_per_shard`` tasks, so that a large shard is never one task's."""
    part = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in placed.columns)), F.lit(files_per_shard))
    placed.repartition(F.col("shard"), part).write.partitionBy("shard").parquet(path)
