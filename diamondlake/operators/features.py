"""Team-game feature engineering (U3 consumers, W6-W10 compositions, J9).

The exponential average (W6) is ``operators.scan.ema_scan`` (range-partitioned
parallel prefix scan, skew-safe); the tests compare it with pandas ``ewm``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up
from diamondlake.operators import windows as WN
from diamondlake.operators.nullsafe import join_null_safe
from diamondlake.operators.prefix import cumulative_sums


def team_game_features(team_games: DataFrame, team: str, order: list[str], season: str, date_col: str,
                       include_current: bool = False, skew_safe: bool = True) -> DataFrame:
    """Q10 features per (team, game): season-to-date win rate and run rates,
    trailing 7-day runs per game, wins in the last ten games.
    ``include_current=False`` (default) uses only earlier games, so a game's
    own result never leaks into its features.  With ``skew_safe`` the running
    and rolling sums come from two-level windows instead of per-team windows; the 7-day RANGE frame stays a window."""
    tg = team_games
    if skew_safe:
        # one running-sum scan per team; season-to-date sums subtract the team's
        # running total just before the season's first game (a per-(team, season)
        # aggregate), and the last-ten sum is S(t-1) - S(t-11) via a rank join.
        cols = ["win", "runs_scored", "runs_allowed", "one"]
        cs = cumulative_sums(tg, [team], order, cols, rank_name="__rk", prefix="__c_")
        before = cs.groupBy(team, season).agg(F.min_by(F.struct(*[
            (F.col(f"__c_{c}") - F.coalesce(F.col(c), F.lit(0))).alias(f"__o_{c}") for c in cols]), F.col("__rk")).alias("__o"))
        cs = join_null_safe(cs, before.select(team, season, "__o.*"), [team, season])
        sub = (lambda c: F.lit(0)) if include_current else (lambda c: F.coalesce(F.col(c), F.lit(0)))
        std = {c: F.col(f"__c_{c}") - F.col(f"__o_{c}") - sub(c) for c in cols}
        for col, out in (("win", "std_win_pct"), ("runs_scored", "std_runs_pg"), ("runs_allowed", "std_runs_allowed_pg")):
            cs = cs.withColumn(out, round_half_up(F.try_divide(std[col].cast("double"), std["one"]), 4))
        back = 10 if include_current else 11
        lag = cs.select(F.col(team).alias("__l_team"), (F.col("__rk") + back).alias("__l_rk"),
                        F.col("__c_win").alias("__l_win"))
        cs = cs.join(lag, cs[team].eqNullSafe(lag["__l_team"]) & (cs["__rk"] == lag["__l_rk"]), "left")
        last10 = F.col("__c_win") - sub("win") - F.coalesce(F.col("__l_win"), F.lit(0))
        cs = cs.withColumn("wins_last_10", last10 if include_current else F.when(F.col("__rk") > 1, last10))
        tg = cs.drop(*[f"__c_{c}" for c in cols], *[f"__o_{c}" for c in cols], "__rk", "__l_team", "__l_rk", "__l_win")
    else:
        tg = WN.running_ratio(tg, [team, season], order, "win", "one", "std_win_pct", include_current)
        tg = WN.running_ratio(tg, [team, season], order, "runs_scored", "one", "std_runs_pg", include_current)
        tg = WN.running_ratio(tg, [team, season], order, "runs_allowed", "one", "std_runs_allowed_pg", include_current)
        tg = WN.rolling_sum(tg, team, order, "win", "wins_last_10", 10, include_current)
    return WN.trailing_days_ratio(tg, team, date_col, "runs_scored", "one", "runs_7d", 7, include_current)


def join_matchup(games: DataFrame, features: DataFrame, key: list[str], side_col: str, feature_cols: list[str],
                 home_prefix: str = "home_", away_prefix: str = "away_") -> DataFrame:
    """One game row ⊕ the home side's feature row ⊕ the away side's, with
    prefixed columns.  Both joins are on the game key, so all three inputs
    shuffle on the same key."""
    def side(flag, prefix):
        f = features.filter(F.col(side_col) == flag)
        return f.select(*key, *[F.col(c).alias(prefix + c) for c in feature_cols])
    return games.join(side(True, home_prefix), key).join(side(False, away_prefix), key)
