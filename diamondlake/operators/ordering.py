"""Sort, top-k, sampling and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.operators.nullsafe import join_null_safe
from diamondlake.operators.prefix import cumulative_sums


def sort_nulls(df: DataFrame, col: str, tiebreak: list[str], nulls_first_desc: bool = True) -> DataFrame:
    """O1: ORDER BY col DESC with NULLs first (the SQL-warehouse default) and a
    total-order tiebreak.  A global sort is a range-partitioned shuffle."""
    first = F.desc_nulls_first(col) if nulls_first_desc else F.desc_nulls_last(col)
    return df.orderBy(first, *[F.asc(c) for c in tiebreak])


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """O2: first n rows by a total order (planned as per-partition top-k + merge)."""
    return df.orderBy(*order).limit(n)


def topk_per_group_mean(df: DataFrame, group: str, order: list[Column], k: int, stats: list[str],
                        digits: int = 4) -> DataFrame:
    """O3: top-k rows per group, then the mean of each stat over them.
    ``row_number() <= k`` is planned with a partial per-partition group limit
    before the shuffle, so a large group is cut to k rows map-side."""
    from diamondlake.functions.scalars import round_half_up
    w = Window.partitionBy(group).orderBy(*order)
    top = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    return top.groupBy(group).agg(F.count(F.lit(1)).alias("n_top"),
                                  *[round_half_up(F.avg(c), digits).alias(f"avg_{c}") for c in stats])


def hash_rank(cols: list[str], seed: int) -> Column:
    """Deterministic pseudo-random order: md5 of the key text and a seed."""
    return F.md5(F.concat(*[F.col(c).cast("string") for c in cols], F.lit(str(seed))))


def sample_one_per_group(df: DataFrame, group: list[str], key: list[str], value_cols: list[str],
                         seed: int = 42) -> DataFrame:
    """One pseudo-random row per group as a ``min_by`` aggregate over the
    md5 rank (map-side partial aggregation; no per-group sort)."""
    packed = F.struct(*[F.col(c) for c in key + value_cols])
    return df.groupBy(*group).agg(F.min_by(packed, hash_rank(key, seed)).alias("__s")).select(
        *group, *[F.col(f"__s.{c}") for c in key + value_cols])


def split_hash(df: DataFrame, key: list[str], train_fraction_hex: str = "cccd", seed: int = 42,
               name: str = "split") -> DataFrame:
    """Stable train/test split from an md5 prefix (0xcccd/0x10000 ~ 0.8),
    identical under any partitioning, unlike ``randomSplit``."""
    return df.withColumn(name, F.when(F.substring(hash_rank(key, seed), 1, 4) < train_fraction_hex,
                                      F.lit("train")).otherwise(F.lit("test")))


def split_chronological(df: DataFrame, entity: str, order: list[str], train_fraction: float = 0.8,
                        name: str = "split", skew_safe: bool = False) -> DataFrame:
    """First 80 % of each entity's rows in time order are train.  The
    per-entity row count is an aggregate; the row rank is a window, or with
    ``skew_safe`` the two-level running count."""
    n = df.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
    if skew_safe:
        ranked = cumulative_sums(df, [entity], order, [], rank_name="__rk")
    else:
        ranked = df.withColumn("__rk", F.row_number().over(Window.partitionBy(entity).orderBy(*order)))
    j = join_null_safe(ranked, n, [entity])
    return j.withColumn(name, F.when(F.col("__rk") <= F.floor(F.col("__n") * train_fraction), "train")
                        .otherwise("test")).drop("__rk", "__n")
