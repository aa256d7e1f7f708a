"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint is the bitwise majority of its word-shingle hashes.
Fingerprints within ``max_bits`` differing bits are linked. The 64 bits are cut
into so many segments that two linked fingerprints always have one segment
within one bit of each other; each distinct fingerprint is put into a table
under each of its segments, and looked up under every value of the radius-1
Hamming ball around them. Matches are verified on all 64 bits inside the join.

Segments have 32 bits at the usual three bits, so a table bucket holds about
one fingerprint even for billions. Buckets that hold more than ``BUCKET``
(families of near copies) go through a second level on the other bits in
the same way; nothing is dropped."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, fresh, id_or_least
from .graph import components

#: Fingerprints under one table key, above which the key's matches are found on a second level.
BUCKET = 256
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text as an unsigned integer. Words are what ASCII
    white space separates, A-Z lower-cased; fewer words than ``shingle`` make
    one shingle, no words (null, empty) make zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), parts), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, CHUNK):
        ones += np.unpackbits(hashes[i:i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long column."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([simhash(t, shingle) for t in s], dtype=np.uint64).view(np.int64))
    return of(text)


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _segments(bits: list[int], max_bits: int) -> list[list[int]]:
    """``bits`` cut into (max_bits + 1) / 2 runs: two words at most
    ``max_bits`` apart differ by at most one bit in some run."""
    n = max(1, (max_bits + 2) // 2)
    return [[int(b) for b in run] for run in np.array_split(bits, n)]


def _mask(run: list[int]) -> int:
    return int(np.array([sum(1 << b for b in run)], dtype=np.uint64).view(np.int64)[0])


def _table(fps: DataFrame, runs: list[list[int]]) -> DataFrame:
    """One row (seg, value, fp) per fingerprint and segment."""
    keys = F.array(*(F.struct(F.lit(i).alias("seg"), F.col("fp").bitwiseAND(F.lit(_mask(r))).alias("value")) for i, r in enumerate(runs)))
    return fps.select("*", F.explode(keys).alias("k")).select(*fps.columns, "k.*")


def _ball(table: DataFrame, runs: list[list[int]]) -> DataFrame:
    """Every row of ``table`` under all values of the radius-1 ball around its own."""
    flips = F.lit(None).cast("array<bigint>")
    for i, r in enumerate(runs):
        flips = F.when(F.col("seg") == i, F.array(F.lit(0), *(F.lit(_mask([b])) for b in r))).otherwise(flips)
    return table.withColumn("flip", F.explode(flips)).withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")


def _verified(left: DataFrame, right: DataFrame, on: list[str], max_bits: int) -> DataFrame:
    """Pairs a < b within ``max_bits`` among rows with equal keys."""
    p, t = left.withColumnRenamed("fp", "a").alias("p"), right.withColumnRenamed("fp", "b").alias("t")
    same = [F.col(f"p.{k}") == F.col(f"t.{k}") for k in on]
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return p.join(t, [*same, F.col("a") < F.col("b"), near]).select("a", "b")


def links(fps: DataFrame, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """All pairs (a < b) of distinct fingerprints (column fp) that differ by at
    most ``max_bits`` bits, each at least once."""
    runs = _segments(list(range(64)), max_bits)
    table = _table(fps, runs)
    probes = _ball(table, runs)
    crowded = checkpoint(table.groupBy("seg", "value").count().where(F.col("count") > bucket).drop("count"))
    if crowded.isEmpty():
        return _verified(probes, table, ["seg", "value"], max_bits)
    key = ["seg", "value"]
    pairs = _verified(probes.join(crowded, key, "left_anti"), table.join(crowded, key, "left_anti"), key, max_bits)
    for i, run in enumerate(runs):
        # The bits outside a crowded key still differ by max_bits at most: the same method on those.
        rest = _segments([b for b in range(64) if b not in run], max_bits)
        here = crowded.where(F.col("seg") == i).select(F.col("value").alias("outer"))
        inner = _table(table.where(F.col("seg") == i).withColumnRenamed("value", "outer").drop("seg").join(here, "outer"), rest)
        outer = _table(probes.where(F.col("seg") == i).withColumnRenamed("value", "outer").drop("seg").join(here, "outer"), rest)
        pairs = pairs.unionByName(_verified(_ball(outer, rest), inner, ["outer", "seg", "value"], max_bits))
    return pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, extra: tuple[Column, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (signed long), ``family``
    (the smallest fingerprint reachable) and ``component_id`` (the smallest id
    reachable), besides ``extra`` columns of ``docs``.

    Null and empty texts have fingerprint zero and link to each other like any
    other; repeated rows each keep a row; rows without an id take part in
    links, and a family in which no row has an id gets a null component_id. An
    empty table gives no rows."""
    rows = checkpoint(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp"), *extra))
    nodes = checkpoint(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    found = components(links(nodes.select("fp"), max_bits))
    linked = nodes.join(found.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("reached"))
    linked = linked.join(least, "component").select("fp", F.col("component").alias("family"), F.col("reached").alias("component_id"))
    copies = nodes.where("n > 1").join(found.select(F.col("node").alias("fp")), "fp", "left_anti").select("fp", F.col("fp").alias("family"), F.col("least").alias("component_id"))
    # Fingerprints that stand alone need no lookup; the rest is a left join that Spark may split on hot ones.
    groups = linked.unionByName(copies).withColumn("grouped", F.lit(True))
    out = rows.join(groups, "fp", "left")
    alone = F.col("grouped").isNull()
    return out.select(F.col("id").alias(id_col), "fp", F.coalesce("family", "fp").alias("family"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), *(c for c in rows.columns if c not in ("id", "fp")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each family of near-duplicates: the one with
    the smallest id, rows without an id last and among those the smallest text
    hash; of repeated rows with that id and text one stays. All columns are
    kept, whatever their names. Each text is shuffled once."""
    no_id, id0, th = fresh(docs, "no_id", "id", "text")
    keys = [F.col(id_col).isNull().alias(no_id), id_or_least(docs, id_col).alias(id0), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias(th)]
    near = near_duplicates(docs, id_col, text_col, shingle, max_bits, tuple(keys))
    kept = near.groupBy("family").agg(F.min(F.struct(no_id, id0, th)).alias("first")).select("first.*")
    found = docs.select("*", *keys).join(kept, [no_id, id0, th], "left_semi")
    return found.dropDuplicates([no_id, id0, th]).select(*(F.col(f"`{c}`") for c in docs.columns))
