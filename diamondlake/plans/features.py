"""Team-game feature table (Q10), exponential averages (W6) and matchups."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up_sql as R
from diamondlake.operators import features as FT
from diamondlake.operators import stats as ST
from diamondlake.operators import team_features as TF
from diamondlake.operators.scan import ema_scan
from diamondlake.plans import team_table as TT
from diamondlake.plans.catalog import register
from diamondlake.plans.windows_sort import TEAM_GAMES_SQL, TEAM_ORDER, team_games

SPAN = 28


def known_team_games(spark, d):
    """Team-game rows of games with both teams known and a decisive score (P10)."""
    tg = team_games(spark, d).filter(F.col("runs_scored") != F.col("runs_allowed"))
    return tg.filter(F.col("offense_team").isNotNull() & F.col("defense_team").isNotNull())


def feature_table(spark, d):
    return FT.team_game_features(known_team_games(spark, d), "offense_team", TEAM_ORDER, "season", "game_date")


def _prior(expr: str, part: str) -> str:
    return (f"{expr} OVER (PARTITION BY {part} ORDER BY game_date, game_pk, is_home "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")


KNOWN_SQL = TEAM_GAMES_SQL + """, k AS (SELECT * FROM tg WHERE runs_scored <> runs_allowed
                                   AND offense_team IS NOT NULL AND defense_team IS NOT NULL)
"""
FEATURE_SQL = KNOWN_SQL + f""", ft AS (
SELECT offense_team, defense_team, game_pk, game_date, is_home, win,
  {R(f"CAST({_prior('SUM(win)', 'offense_team, season')} AS DOUBLE) / NULLIF({_prior('SUM(one)', 'offense_team, season')}, 0)", 4)} AS std_win_pct,
  {R(f"CAST({_prior('SUM(runs_scored)', 'offense_team, season')} AS DOUBLE) / NULLIF({_prior('SUM(one)', 'offense_team, season')}, 0)", 4)} AS std_runs_pg,
  {R(f"CAST({_prior('SUM(runs_allowed)', 'offense_team, season')} AS DOUBLE) / NULLIF({_prior('SUM(one)', 'offense_team, season')}, 0)", 4)} AS std_runs_allowed_pg,
  {R("CAST(SUM(runs_scored) OVER w7 AS DOUBLE) / NULLIF(SUM(one) OVER w7, 0)", 4)} AS runs_7d,
  CAST(SUM(win) OVER (PARTITION BY offense_team ORDER BY game_date, game_pk, is_home ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS BIGINT) AS wins_last_10
FROM k WINDOW w7 AS (PARTITION BY offense_team ORDER BY game_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
"""


TEAM_TABLE = f"""game_pk, day AS game_date, season, offense_team, defense_team, is_home, total_games, total_runs,
       {', '.join(TF.FEATURES)}, runs_scored, win"""


@register("q_team_game_features", TT.TABLE_SQL + f"SELECT {TEAM_TABLE} FROM ft")
def q_team_game_features(spark, d):
    """Q10: per team and game, 23 hitting features of the team and 13 pitching features of
    its opponent from earlier days only, plus the runs and the win."""
    return TT.feature_table(spark, d).withColumnRenamed("day", "game_date")


def _corr_sql():
    cols = [*TF.FEATURES, "win"]
    known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    cells = ", ".join(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j)
    rows = " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, c{min(i, j)}_{max(i, j)} AS c FROM one" for i, a in enumerate(cols) for j, b in enumerate(cols))
    return TT.TABLE_SQL + f""", one AS MATERIALIZED (SELECT {cells} FROM ft WHERE {known})
SELECT feature_a, feature_b, {R('CASE WHEN NOT isnan(c) THEN c END', 4)} AS corr FROM ({rows})"""


@register("corr_matrix", _corr_sql())
def corr_matrix(spark, d):
    """Correlation matrix (long form) of the 36 features and the win, over complete rows."""
    return ST.corr_matrix(TT.feature_table(spark, d), [*TF.FEATURES, "win"])


ALPHA = 1.0 / (1.0 + (SPAN - 1) / 2.0)


@register("win_ema", KNOWN_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""", seq AS (
  SELECT offense_team, game_pk, is_home, CAST(runs_scored AS DOUBLE) AS x1, CAST(runs_allowed AS DOUBLE) AS x2,
         ROW_NUMBER() OVER (PARTITION BY offense_team ORDER BY game_date, game_pk, is_home) AS i FROM k),
ema AS (
  SELECT offense_team, i, game_pk, is_home, x1 AS e1, x2 AS e2 FROM seq WHERE i = 1
  UNION ALL
  SELECT s.offense_team, s.i, s.game_pk, s.is_home,
         ({1.0 - ALPHA!r} * e.e1 + {ALPHA!r} * s.x1) / ({1.0 - ALPHA!r} + {ALPHA!r}),
         ({1.0 - ALPHA!r} * e.e2 + {ALPHA!r} * s.x2) / ({1.0 - ALPHA!r} + {ALPHA!r})
  FROM ema e JOIN seq s ON s.offense_team = e.offense_team AND s.i = e.i + 1)
SELECT offense_team, game_pk, is_home, {R('e1', 4)} AS runs_scored_ema, {R('e2', 4)} AS runs_allowed_ema FROM ema""")
def win_ema(spark, d):
    """Exponential moving average (span 28, adjust=False) of runs scored and
    allowed per team in game order."""
    tg = known_team_games(spark, d)
    out = ema_scan(tg, "offense_team", TEAM_ORDER, ["runs_scored", "runs_allowed"], span=SPAN)
    return out.select("offense_team", "game_pk", "is_home", "runs_scored_ema", "runs_allowed_ema")


@register("join_matchup", FEATURE_SQL + f""", g AS (SELECT DISTINCT game_pk, game_date FROM k)
SELECT g.game_pk, g.game_date, h.offense_team AS home_offense_team, h.std_win_pct AS home_std_win_pct,
       h.runs_7d AS home_runs_7d, a.offense_team AS away_offense_team, a.std_win_pct AS away_std_win_pct,
       a.runs_7d AS away_runs_7d
FROM g JOIN ft h ON h.game_pk = g.game_pk AND h.is_home JOIN ft a ON a.game_pk = g.game_pk AND NOT a.is_home""")
def join_matchup(spark, d):
    """Home team's feature row ⊕ away team's feature row per game."""
    ft = feature_table(spark, d)
    games = ft.select("game_pk", "game_date").distinct()
    return FT.join_matchup(games, ft, ["game_pk"], "is_home", ["offense_team", "std_win_pct", "runs_7d"])
