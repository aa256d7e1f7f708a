"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontamination, hard_negatives, html_extraction, license_scan, mixing, ngram_join, pu_quality, quality_rules, sharding, simhash_dedup, toxicity, url_filters
from .common import held_out, table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash_dedup.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pu_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 100 against all rows; every seventh id has its label moved on."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label_col=label)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_all(conversation_repair.damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents")).withColumnRenamed("n", "n_shingles")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_url_filters, op3_simhash_dedup, op4_toxicity, op5_pu_quality, op6_license_scan, op7_mixing, op8_quality_rules, op9_decontamination, op10_sharding, op11_hard_negatives, op12_conversation_repair, op13_ngram_join)
}


def oracle_sql() -> dict[str, str]:
    slots = ",".join(map(str, sharding.fill_table([f"shard-{i}" for i in range(sharding.SHARDS)])))
    return {
        "op8_quality_rules": quality_rules.ORACLE_SQL,
        "op10_sharding": f"""
            WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 15))::BIGINT % {sharding.SLOTS} AS slot FROM documents)
            SELECT doc_id, slot, CAST(string_split('{slots}', ',')[slot + 1] AS INTEGER) AS shard FROM d""",
    }
