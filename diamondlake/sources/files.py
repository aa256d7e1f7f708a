"""File and database sources/sinks.

Scratch and table locations live under the cluster's shared
``spark.checkpoint.dir`` (never a machine-local folder), so every executor
and a restarted driver see the same files."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from diamondlake.session import ensure_checkpoint_dir

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "diamondlake", f"{name}-{uuid.uuid4().hex[:12]}")


def _has_files(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001  (remote session: fall back to trying the read)
        try:
            spark.read.text(path).limit(1).collect()
            return True
        except Exception:  # noqa: BLE001
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) and s.getLen() > 0 for s in fs.listStatus(p)) \
        if fs.getFileStatus(p).isDirectory() else fs.getFileStatus(p).getLen() > 0


def scan_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header and an explicit schema; a missing/empty file or
    directory is "no data" (an empty frame), not a failure."""
    if not _has_files(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("header", True).option("timestampFormat", TS_FORMAT)
            .option("timestampNTZFormat", TS_FORMAT).option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with header, no index column; timestamps keep microseconds."""
    (df.write.mode(mode).option("header", True).option("timestampFormat", TS_FORMAT)
       .option("timestampNTZFormat", TS_FORMAT).csv(path))
    return path


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """S3: JDBC scan.  With ``partition_column`` the read is split into
    ``num_partitions`` range queries that run in parallel on the executors."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query:
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10000,
               num_partitions: int | None = None, properties: dict | None = None) -> None:
    """S5 to a database: batched inserts from each partition."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def write_warehouse(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                    max_records_per_file: int = 5_000_000) -> str:
    """Parquet table partitioned by season.  Rows are clustered by the
    partition column inside each task so each task keeps one open writer."""
    out = df.sortWithinPartitions(*partition_by) if partition_by else df
    w = out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_rows(df: DataFrame, path: str, columns: list[str]) -> str:
    """Bulk append in the target's explicit column order."""
    df.select(*columns).write.mode("append").parquet(path)
    return path


def calendar_spine(spark: SparkSession, start_col_df: DataFrame, start: str, end: str,
                   past_only: bool = True, name: str = "game_date") -> DataFrame:
    """One row per day between the ``start``/``end`` columns of a one-row
    frame (e.g. a min/max aggregate); days before today only."""
    days = start_col_df.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))).alias(name))
    return days.filter(F.col(name) < F.current_date()) if past_only else days


def season_bounds(start: str, end: str) -> tuple[str, str]:
    """A load range must sit inside one season (calendar year)."""
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if e < s:
        raise ValueError(f"end {end} before start {start}")
    if s.year != e.year:
        raise ValueError(f"range {start}..{end} spans seasons {s.year} and {e.year}; load one season at a time")
    return start, end


def season_slice(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """Rows of one season between two dates (inclusive), pushed to the scan."""
    start, end = season_bounds(start, end)
    end_excl = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    return df.filter((F.col(date_col) >= F.lit(start).cast("timestamp")) & (F.col(date_col) < F.lit(end_excl).cast("timestamp")))


def cut_lineage_to(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to the shared store and read it back: cuts lineage and
    decouples a read of a table from a later write to the same table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
