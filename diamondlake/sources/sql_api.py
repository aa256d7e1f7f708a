"""SQL entry point: analysts' leaderboard SQL runs on Spark SQL with named
parameters (``spark.sql(text, args=...)``) instead of interpolated strings,
over temp views of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from diamondlake.sources.tables import TABLES, load


def register_views(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    """Temp views over the Parquet tables (lazy; Catalyst still prunes and pushes down)."""
    for t in tables or TABLES:
        load(spark, sf_dir, t).createOrReplaceTempView(t)


def run_sql(spark: SparkSession, sf_dir: str, text: str, **params) -> DataFrame:
    """Run parameterised SQL (``:name`` markers bound from ``params``)."""
    register_views(spark, sf_dir)
    return spark.sql(text, args=params)
