"""Corpus pipeline: documents -> training shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
rows that its predecessor kept. All stages but the last return the columns of
documents; the last adds ``slot`` and ``shard``. Stage results are written as
Parquet in the shared checkpoint folder and read again, which also cuts
lineage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from diamondlake.llm import decontamination, mixing, sharding, simhash_dedup, toxicity
from diamondlake.llm.common import prepare, table
from diamondlake.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model is learned from the labelled rows among ``docs``."""
    prepare(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash family stays."""
    prepare(spark)
    return simhash_dedup.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.apply_mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    prepare(spark)
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents."""
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The toxicity model, fingerprints, edit distances and balanced draws can't be written in SQL. The tests hold the operators against brute force, of run() only columns, known ids and shards.
ORACLE_SQL = None
