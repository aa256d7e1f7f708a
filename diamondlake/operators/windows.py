"""Window operators.

Unordered "per group" values (W1) and "latest row" (W2) are aggregates,
partially aggregated map-side and therefore skew-safe.  Ordered operators
(lag, streaks, running and rolling sums, running accuracy) take
``skew_safe=True`` to run on the two-level windows of ``prefix.py``
instead of one window partition per entity; the plain window form is for
groups known to be small (e.g. one game's pitches).  The trailing-days ratio
always windows over daily totals (at most one row per entity and day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up
from diamondlake.operators.nullsafe import join_null_safe
from diamondlake.operators.prefix import cumulative_sums, neighbours
from diamondlake.session import store


def partition_avg_max(df: DataFrame, key: str, value: str, avg_name: str, max_name: str,
                      digits: int | None = 4) -> DataFrame:
    """AVG and MAX of ``value`` over all rows with the same ``key``.
    Expressed as groupBy + join back instead of an unordered window, so a hot key
    is combined map-side instead of landing in one task. The values per key are
    written first: Spark then knows their size and broadcasts few keys, so that
    the rows aren't dealt out by them."""
    avg = F.avg(value)
    per_key = df.groupBy(key).agg((round_half_up(avg, digits) if digits is not None else avg).alias(avg_name),
                                  F.max(value).alias(max_name))
    return join_null_safe(df, store(per_key), [key], "left")


def latest_row(df: DataFrame, key: str, order_cols: list[str], value_cols: list[str],
               descending: bool = True) -> DataFrame:
    """Values of the latest row per key (``row_number() ... = 1``) as a
    ``max_by`` over a struct of the order columns (a total order is required)."""
    ordering = F.struct(*order_cols)
    pick = F.max_by if descending else F.min_by
    packed = F.struct(*[F.col(c).alias(c) for c in value_cols + order_cols])
    return df.groupBy(key).agg(pick(packed, ordering).alias("__r")).select(key, "__r.*")


def lag_value(df: DataFrame, partition: list[str], order: list[str], col: str, name: str,
              offset: int = 1, skew_safe: bool = False) -> DataFrame:
    """Previous value within the partition (``skew_safe``: two-level windows,
    offset 1, total order required)."""
    if skew_safe:
        if offset != 1:
            raise ValueError("the skew-safe lag supports offset 1")
        return neighbours(df, list(partition), list(order), col, name, "__next_unused").drop("__next_unused")
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.lag(col, offset).over(w))


def lead_value(df: DataFrame, partition: list[str], order: list[str], col: str, name: str,
               offset: int = 1, skew_safe: bool = False) -> DataFrame:
    """Next value within the partition (e.g. bases after the pitch).  The
    registered query partitions by game, which is bounded by the game's length;
    ``skew_safe`` uses two-level windows (offset 1, total order required)."""
    if skew_safe:
        if offset != 1:
            raise ValueError("the skew-safe lead supports offset 1")
        return neighbours(df, list(partition), list(order), col, "__prev_unused", name).drop("__prev_unused")
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.lead(col, offset).over(w))


def streaks(games: DataFrame, entity: str, order_col: str, hit_col: str, as_written: bool = True,
            tiebreak: list[str] = (), skew_safe: bool = False) -> DataFrame:
    """W4 gaps-and-islands over one row per (entity, game).

    State flag = hit in this game; change flag = state differs from the
    previous game's (no previous game counts as "no hit"); island id = running
    SUM of change flags.  ``as_written`` keeps the default RANGE frame (games
    on the same date share a sum) and measures islands of *any* state, as the
    leaderboard SQL does; otherwise a ROWS frame with ``tiebreak`` and only
    islands of games with a hit.  ``skew_safe`` takes the previous game and the
    island id from two-level windows (a total order
    (order_col + tiebreak) is then required; with one game per date it equals
    the RANGE form).  Returns (entity, best_streak)."""
    if skew_safe:
        order = [order_col, *tiebreak]
        seq = neighbours(games.select(entity, *order, hit_col), [entity], order, hit_col, "__prev", "__next")
        flags = (seq.withColumn("__before", F.when(F.col("__prev") > 0, 1).otherwise(0))
                 .withColumn("__now", F.when(F.col(hit_col) > 0, 1).otherwise(0))
                 .withColumn("__chg", F.when(F.col("__before") != F.col("__now"), 1).otherwise(0).cast("long")))
        isl = cumulative_sums(flags, [entity], order, ["__chg"], rank_name="__rk", prefix="__isl")
        isl = isl.withColumnRenamed("__isl__chg", "__island")
    else:
        order = [F.col(order_col)] + [F.col(c) for c in tiebreak]
        w = Window.partitionBy(entity).orderBy(*order)
        flags = (games
                 .withColumn("__before", F.when(F.lag(hit_col).over(w) > 0, 1).otherwise(0))
                 .withColumn("__now", F.when(F.col(hit_col) > 0, 1).otherwise(0))
                 .withColumn("__chg", F.when(F.col("__before") != F.col("__now"), 1).otherwise(0)))
        if as_written:
            run = Window.partitionBy(entity).orderBy(F.col(order_col)).rangeBetween(Window.unboundedPreceding, 0)
        else:
            run = w.rowsBetween(Window.unboundedPreceding, 0)
        isl = flags.withColumn("__island", F.sum("__chg").over(run))
    if not as_written:
        isl = isl.filter(F.col("__now") == 1)
    per_island = isl.groupBy(entity, "__island").agg(F.count(F.lit(1)).alias("__len"))
    return per_island.groupBy(entity).agg(F.max("__len").alias("best_streak"))


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def running_ratio(df: DataFrame, entity, order, num: str, den: str, name: str,
                  include_current: bool = True, digits: int = 4, skew_safe: bool = False) -> DataFrame:
    """W7 season-to-date rate: running SUM(num)/SUM(den) from the first row of
    the partition.  ``include_current=False`` stops at the previous row, so a
    game's own result does not leak into its feature.  ``skew_safe`` computes
    the running sums in two levels of windows, so a hot entity is not processed
    by one task."""
    if skew_safe:
        cs = cumulative_sums(df, _as_list(entity), _as_list(order), [num, den], rank_name="__rk", prefix="__cum_")
        n = F.col(f"__cum_{num}") - (F.lit(0) if include_current else F.coalesce(F.col(num), F.lit(0)))
        d = F.col(f"__cum_{den}") - (F.lit(0) if include_current else F.coalesce(F.col(den), F.lit(0)))
        return cs.withColumn(name, round_half_up(F.try_divide(n.cast("double"), d), digits)).drop(
            f"__cum_{num}", f"__cum_{den}", "__rk")
    end = 0 if include_current else -1
    w = Window.partitionBy(*_as_list(entity)).orderBy(*_as_list(order)).rowsBetween(Window.unboundedPreceding, end)
    return df.withColumn(name, round_half_up(F.try_divide(F.sum(num).over(w).cast("double"), F.sum(den).over(w)), digits))


def trailing_days_ratio(df: DataFrame, entity, date_col: str, num: str, den: str, name: str,
                        days: int = 7, include_current: bool = True, digits: int = 4) -> DataFrame:
    """W8 trailing window ``[d-days, d]`` on a date column (all games of a day
    are in or out together); ``include_current=False`` gives ``[d-days, d-1]``.

    The sums are first aggregated to one row per (entity, day), the RANGE
    window runs over those daily rows (at most one per calendar day per
    entity, whatever the entity's volume), and the ratio is joined back on
    (entity, day)."""
    ent = _as_list(entity)
    end = 0 if include_current else -1
    daily = df.groupBy(*ent, date_col).agg(F.sum(num).alias("__dn"), F.sum(den).alias("__dd"))
    dn = F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*ent).orderBy(dn).rangeBetween(-days, end)
    daily = daily.select(*ent, date_col, round_half_up(
        F.try_divide(F.sum("__dn").over(w).cast("double"), F.sum("__dd").over(w)), digits).alias(name))
    return join_null_safe(df, daily, [*ent, date_col], "left")


def running_accuracy(df: DataFrame, date_col: str, tiebreak: str, correct_col: str,
                     digits: int = 4, skew_safe: bool = False) -> DataFrame:
    """W9 running accuracy over all rows in (date, tiebreak) order without one
    global sort task.  Default: per-date totals (one row per date) give each
    date's offset and a window partitioned by date ranks rows inside it.
    ``skew_safe``: the same in the general two-level form."""
    if skew_safe:
        src = df.withColumn("__all", F.lit(0)).withColumn("__ok", F.col(correct_col).cast("long"))
        cs = cumulative_sums(src, ["__all"], [date_col, tiebreak], ["__ok"], rank_name="games_so_far", prefix="__cum", bucket=F.col(date_col))
        return cs.withColumn("correct_so_far", F.col("__cum__ok")).withColumn(
            "running_accuracy", round_half_up(F.col("correct_so_far") / F.col("games_so_far"), digits)).drop(
            "__all", "__ok", "__cum__ok")
    per_date = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("__n"),
                                       F.sum(F.col(correct_col).cast("int")).alias("__c"))
    wd = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_date.select(date_col, F.coalesce(F.sum("__n").over(wd), F.lit(0)).alias("__n0"),
                              F.coalesce(F.sum("__c").over(wd), F.lit(0)).alias("__c0"))
    wi = Window.partitionBy(date_col).orderBy(tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.withColumn("__ni", F.count(F.lit(1)).over(wi)).withColumn(
        "__ci", F.sum(F.col(correct_col).cast("int")).over(wi))
    j = inner.join(F.broadcast(offsets), date_col)      # one row per date
    return j.withColumn("games_so_far", F.col("__n0") + F.col("__ni")).withColumn(
        "correct_so_far", F.col("__c0") + F.col("__ci")).withColumn(
        "running_accuracy", round_half_up(F.col("correct_so_far") / F.col("games_so_far"), digits)).drop(
        "__n0", "__c0", "__ni", "__ci")


def rolling_sum(df: DataFrame, entity, order, col: str, name: str, rows: int = 10,
                include_current: bool = True, skew_safe: bool = False) -> DataFrame:
    """Rolling sum of the last ``rows`` rows (min_periods 1); with
    ``include_current=False`` the ``rows`` rows before the current one (NULL
    for an entity's first row).  ``skew_safe``: S(t) - S(t-rows) from the
    two-level running sum, the lagged S fetched by a join on
    (entity, rank) -- unique keys, so a hot entity's rows hash-spread evenly."""
    ent = _as_list(entity)
    if skew_safe:
        cs = cumulative_sums(df, ent, _as_list(order), [col], rank_name="__rk", prefix="__cum_")
        back = rows if include_current else rows + 1
        lagged = cs.select(*[F.col(e).alias(f"__l_{e}") for e in ent], (F.col("__rk") + back).alias("__l_rk"),
                           F.col(f"__cum_{col}").alias("__l_cum"))
        cond = [cs[e].eqNullSafe(lagged[f"__l_{e}"]) for e in ent] + [cs["__rk"] == lagged["__l_rk"]]
        j = cs.join(lagged, cond, "left")
        upto = F.col(f"__cum_{col}") - (F.lit(0) if include_current else F.coalesce(F.col(col), F.lit(0)))
        val = upto - F.coalesce(F.col("__l_cum"), F.lit(0))
        if not include_current:
            val = F.when(F.col("__rk") > 1, val)
        return j.withColumn(name, val).drop(f"__cum_{col}", "__rk", *[f"__l_{e}" for e in ent], "__l_rk", "__l_cum")
    frame = (-(rows - 1), 0) if include_current else (-rows, -1)
    w = Window.partitionBy(*ent).orderBy(*_as_list(order)).rowsBetween(*frame)
    return df.withColumn(name, F.sum(col).over(w))
