"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from diamondlake.session import cut_lineage, ensure_checkpoint_dir, ship_package
from diamondlake.sources.tables import load

#: Python code of the word separators the operators share: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
WORD_RE = "[^\\x20\\x09-\\x0D]+"

#: Rows and bytes of one Arrow batch; whole documents can be long, so batches stay small.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Shared checkpoint folder, package on the workers, UTC, and Arrow batches
    bounded by rows and bytes, because one row can hold a very long text."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(prepare(spark), sf_dir, name)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of ``spark.checkpoint.dir``."""
    return cut_lineage(df)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        n = f"__{n}"
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def id_or_least(df: DataFrame, name: str) -> Column:
    """The id with a value of its own type in place of null: 0, or the empty string."""
    return F.coalesce(F.col(name), F.lit("") if isinstance(df.schema[name].dataType, StringType) else F.lit(0))


def id_key(df: DataFrame, name: str) -> Column:
    """A whole number by id: the id itself if it is one, else its hash; 0 for null."""
    col = F.col(name)
    return F.coalesce(col if isinstance(df.schema[name].dataType, IntegralType) else F.when(col.isNotNull(), F.xxhash64(col)), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    """Number of words between separators; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def is_training(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text mod 3 is not 1."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
