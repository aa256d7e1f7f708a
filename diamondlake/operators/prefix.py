"""Running sums, ranks and neighbours of ordered rows in two levels of windows.

A window per group would bring a hot group into one task. Here a group's rows
are cut into buckets along the order (months of a date, days of a timestamp):
one window runs inside each (group, bucket), so a hot group spreads over its
buckets, and one over the buckets' totals or edges, of which a group has as
many as the calendar allows. Both are plain windows, joined on (group, bucket)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.operators.nullsafe import join_null_safe


def default_bucket(df: DataFrame, col: str) -> Column:
    """A column that never falls as ``col`` rises: months of dates, days of timestamps, else ``col`` itself."""
    kind = df.schema[col].dataType.typeName()
    if kind == "date":
        return F.trunc(col, "month")
    return F.to_date(col) if kind.startswith("timestamp") else F.col(col)


def cumulative_sums(df: DataFrame, group: list[str], order: list[str], cols: list[str], rank_name: str = "__rank",
                    prefix: str = "cum_", bucket: Column | None = None) -> DataFrame:
    """Running sums (the row included, NULL as 0) of ``cols`` and the row number per
    ``group`` in ``order`` (a total order, NULLs first). NULL keys form a group."""
    rows = df.withColumn("__b", default_bucket(df, order[0]) if bucket is None else bucket)
    keys = [*group, "__b"]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    inner = rows.select("*", *[F.coalesce(F.sum(c).over(inside), zero).alias(f"__in_{c}") for c in cols], F.count(F.lit(1)).over(inside).alias("__in___rows"))
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__t___rows"), *[F.sum(c).alias(f"__t_{c}") for c in cols])
    earlier = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, *[F.coalesce(F.sum(f"__t_{c}").over(earlier), zero).alias(f"__before_{c}") for c in ["__rows", *cols]])
    both = join_null_safe(inner, before, keys)
    sums = [(F.col(f"__in_{c}") + F.col(f"__before_{c}")).alias(prefix + c) for c in cols]
    return both.select(*df.columns, *sums, (F.col("__in___rows") + F.col("__before___rows")).cast("bigint").alias(rank_name))


def neighbours(df: DataFrame, group: list[str], order: list[str], value: str, prev_name: str, next_name: str, bucket: Column | None = None) -> DataFrame:
    """``value`` of the row before and the row after, per ``group`` in ``order`` (a
    total order, NULLs first); NULL at a group's ends. NULL keys form a group."""
    rows = df.withColumn("__b", default_bucket(df, order[0]) if bucket is None else bucket)
    keys = [*group, "__b"]
    inside, along = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*group).orderBy("__b")
    held = F.struct(F.col(value).alias("v"))           # a NULL value isn't a missing row
    inner = rows.withColumns({"__p": F.lag(held).over(inside), "__n": F.lead(held).over(inside)})
    edges = inner.where("__p IS NULL OR __n IS NULL").groupBy(*keys).agg(
        F.max(F.when(F.col("__p").isNull(), held)).alias("__first"), F.max(F.when(F.col("__n").isNull(), held)).alias("__last"))
    edges = edges.select(*keys, F.lag("__last").over(along).alias("__before"), F.lead("__first").over(along).alias("__after"))
    both = join_null_safe(inner, edges, keys)
    return both.select(*df.columns, F.coalesce("__p", "__before")["v"].alias(prev_name), F.coalesce("__n", "__after")["v"].alias(next_name))
