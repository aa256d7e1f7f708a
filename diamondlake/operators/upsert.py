"""Upsert and incremental loading.

The merge touches only the keys present in the (small, daily) source batch:
target rows whose key is not in the batch pass through a left-anti join that
is driven by the batch's key set, and only the batch is joined back to the
target to keep the columns it does not update.  The whole target is never
shuffled against itself; the new snapshot is written to a new location and
swapped in, so a failed run leaves the previous snapshot intact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def upsert_by_key(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
                  source_order: list[str] | None = None, audit: bool = False) -> DataFrame:
    """Insert new keys with all columns that the source has; on key conflict
    overwrite ``update_cols`` and keep the target's other columns.  Duplicate keys inside the
    batch keep the last by ``source_order`` (late duplicates).  With ``audit``
    the target's ``created_at`` is kept and ``updated_at`` is set (D5)."""
    if source_order:
        rest = [c for c in source.columns if c not in keys]
        source = keep_last(source, keys, source_order, rest)
    cols = [c for c in target.columns if c not in keys and c not in ("created_at", "updated_at")]
    update_cols = [c for c in (update_cols if update_cols is not None else cols) if c in source.columns]
    src_keys = source.select(*keys)
    untouched = target.join(src_keys, keys, "left_anti")
    t = target.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("__hit"))
    merged = source.join(t, keys, "left")
    out_cols = []
    for c in cols:
        if c in update_cols:
            out_cols.append(F.col(c).alias(c))
        else:
            kept = F.col(f"__t_{c}")
            out_cols.append((F.when(F.col("__hit"), kept).otherwise(F.col(c)) if c in source.columns else kept).alias(c))
    if audit:
        now = F.current_timestamp()
        tc = "__t_created_at" if "created_at" in target.columns else None
        out_cols.append((F.coalesce(F.col(tc), now) if tc else now).alias("created_at"))
        out_cols.append(now.alias("updated_at"))
    merged = merged.select(*keys, *out_cols)
    if audit and "created_at" not in target.columns:
        untouched = untouched.withColumn("created_at", F.current_timestamp()).withColumn("updated_at", F.current_timestamp())
    return untouched.select(*merged.columns).unionByName(merged)


def keep_last(df: DataFrame, keys: list[str], order: list[str], rest: list[str]) -> DataFrame:
    """One row per key, the last by ``order``, with the columns ``rest``."""
    packed = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max_by(packed, F.struct(*[F.col(c) for c in order])).alias("__r")).select(
        *keys, *[F.col(f"__r.{c}") for c in rest])


def incremental_append(existing: DataFrame, batch: DataFrame, keys: list[str],
                       order: list[str] | None = None) -> DataFrame:
    """Rows of the batch whose key is not stored yet; duplicate keys inside
    the batch keep the first row by ``order`` (default: the other columns), so
    a retried run appends exactly the same rows.  Appending the result is
    idempotent on re-run."""
    from diamondlake.operators.keys import dedup_keep_first
    rest = [c for c in batch.columns if c not in keys]
    first = dedup_keep_first(batch, keys, order or rest) if rest else batch.select(*keys).distinct()
    return first.select(*batch.columns).join(existing.select(*keys), keys, "left_anti")


def pending_dates(calendar: DataFrame, loaded: DataFrame, date_col: str) -> DataFrame:
    """Calendar days not loaded yet (left anti join on the date)."""
    return calendar.join(loaded.select(F.col(date_col)).distinct(), date_col, "left_anti")
