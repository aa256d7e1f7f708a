"""Q10 on the test tables: games are orders, plate appearances their lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up_sql as R
from diamondlake.operators import team_features as TF
from diamondlake.plans.standins import games_df
from diamondlake.plans.windows_sort import TEAM_GAMES_SQL, team_games
from diamondlake.session import store
from diamondlake.sources.tables import load

# Fixed values (stand-in plate appearances): what a line's flags and amounts mean. A returned line is a
# hit, its quantity gives the bases; an accepted one is an out; any other a walk, a sacrifice fly or an out.
COUNTERS = {
    "pa": "TRUE",
    "ab": "l_returnflag IN ('R', 'A') OR (l_discount > 0.01e0 AND l_discount < 0.06e0)",
    "h": "l_returnflag = 'R'",
    "d2": "l_returnflag = 'R' AND l_quantity > 25 AND l_quantity <= 38",
    "d3": "l_returnflag = 'R' AND l_quantity > 38 AND l_quantity <= 44",
    "hr": "l_returnflag = 'R' AND l_quantity > 44",
    "bb": "l_returnflag NOT IN ('R', 'A') AND l_discount >= 0.06e0",
    "so": "l_returnflag = 'A' AND l_tax > 0.04e0",
    "sf": "l_returnflag NOT IN ('R', 'A') AND l_discount <= 0.01e0",
    "sb": "l_returnflag <> 'A' AND l_discount > 0.08e0",
    "rbi": "l_returnflag = 'R' AND (l_quantity > 44 OR l_tax > 0.04e0)",
    "outs": "l_returnflag = 'A' OR (l_returnflag <> 'R' AND l_discount < 0.06e0)",
    "p_so": "l_returnflag = 'A' AND l_tax > 0.04e0",
    "p_bb": "l_returnflag NOT IN ('R', 'A') AND l_discount >= 0.06e0",
    "p_hr": "l_returnflag = 'R' AND l_quantity > 44",
    "er": "l_returnflag = 'R' AND (l_quantity > 44 OR l_tax > 0.04e0)",
}
COUNTER_COLS = [f"CAST(COALESCE({x}, FALSE) AS BIGINT) AS {c}" for c, x in COUNTERS.items()]
#: The counters of a plate appearance as the bits of one number.
FLAGS = " + ".join(f"CASE WHEN {x} THEN {1 << k} ELSE 0 END" for k, x in enumerate(COUNTERS.values()))


def stored_games(spark, d):
    """The games that the feature table reads several times, written once in the order of their days."""
    g = games_df(spark, d).select("game_pk", "game_date", "game_year", "home_team", "away_team", "home_score", "away_score")
    return store(g.repartitionByRange("game_date", "game_pk").sortWithinPartitions("game_date"))


def appearances(spark, d, games):
    """Plate appearances of ``games`` with both teams known: the away team bats in the top of an inning. Written
    once, as both sides read them; the counters travel as one number."""
    li = load(spark, d, "lineitem").selectExpr("l_orderkey", "l_partkey AS batter", "l_suppkey AS pitcher", "l_linestatus", f"{FLAGS} AS flags")
    g = games.select("game_pk", F.col("game_date").alias("day"), F.col("game_year").alias("season"), "home_team", "away_team")
    g = g.where("home_team IS NOT NULL AND away_team IS NOT NULL")
    top = F.col("l_linestatus") == "O"
    seen = store(li.join(g, li.l_orderkey == g.game_pk).select(
        "day", "season", F.when(top, F.col("away_team")).otherwise(F.col("home_team")).alias("offense_team"),
        F.when(top, F.col("home_team")).otherwise(F.col("away_team")).alias("defense_team"), "batter", "pitcher", "flags"))
    counters = [F.shiftright("flags", k).bitwiseAND(1).cast("long").alias(c) for k, c in enumerate(COUNTERS)]
    return seen.select("day", "season", "offense_team", "defense_team", "batter", "pitcher", *counters)


def decided_games(spark, d, games):
    """Team-game rows of ``games`` with both teams known and a decisive score (P10)."""
    tg = team_games(spark, d, games).filter(F.col("runs_scored") != F.col("runs_allowed"))
    tg = tg.filter(F.col("offense_team").isNotNull() & F.col("defense_team").isNotNull())
    return tg.select("game_pk", F.col("game_date").alias("day"), "season", "offense_team", "defense_team", "is_home", "runs_scored", "runs_allowed")


def feature_table(spark, d):
    games = stored_games(spark, d)
    return TF.team_game_table(decided_games(spark, d, games), appearances(spark, d, games))


def _side_sql(name: str, team: str, player: str, cols: list[str], rates: dict, week: list[str], active: str) -> str:
    """CTEs of one side by range joins: {name}_std, {name}_week and {name}_five per (team, day) of the spine."""
    sums = ", ".join(f"SUM(p.{c}) AS {c}" for c in cols)
    lg = ", ".join(f"SUM(p.{c}) AS lg_{c}" for c in cols)
    rate = ", ".join(f"{R(rates[c], TF.DIGITS)} AS {c}" for c in rates)
    weekly = ", ".join(f"{R(rates[c], TF.DIGITS)} AS {c}_week" for c in week)
    micro = ", ".join(f"CAST(FLOOR(({rates[c]}) * {TF.MICRO} + 0.5e0) AS BIGINT) AS {c}" for c in week)
    five = ", ".join(f"{R(f'CAST(SUM({c}) AS DOUBLE) / NULLIF(COUNT({c}), 0) / {TF.MICRO}e0', TF.DIGITS)} AS {c}_5" for c in week)
    return f"""
{name}_pd AS (SELECT {team} AS team, {player} AS player, season, day, {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {c}' for c in cols)} FROM pa GROUP BY 1, 2, 3, 4),
{name}_known AS (SELECT s.team, s.season, s.day, p.player, {', '.join(f'COALESCE(p.{c}, 0) AS {c}' for c in cols)}
  FROM spine s LEFT JOIN {name}_pd p ON s.team = p.team AND s.season = p.season AND s.day = p.day),
{name}_lgd AS (SELECT season, day, {', '.join(f'SUM({c}) AS {c}' for c in cols)} FROM {name}_known GROUP BY 1, 2),
{name}_lg AS (SELECT s.season, s.day, {lg} FROM (SELECT DISTINCT season, day FROM spine) s JOIN {name}_lgd p ON p.season = s.season AND p.day < s.day GROUP BY 1, 2),
{name}_lgw AS (SELECT s.day, {lg} FROM (SELECT DISTINCT day FROM spine) s JOIN {name}_lgd p ON p.day BETWEEN s.day - 7 AND s.day - 1 GROUP BY 1),
{name}_td AS (SELECT s.team, s.season, s.day, {sums} FROM spine s JOIN {name}_known p ON p.team = s.team AND p.season = s.season AND p.day < s.day GROUP BY 1, 2, 3),
{name}_std AS (SELECT team, x.day, {rate} FROM {name}_td x JOIN {name}_lg g ON g.season = x.season AND g.day = x.day),
{name}_tw AS (SELECT s.team, s.day, {sums} FROM spine s JOIN {name}_known p ON p.team = s.team AND p.day BETWEEN s.day - 7 AND s.day - 1 GROUP BY 1, 2),
{name}_week AS (SELECT team, x.day, {weekly} FROM {name}_tw x JOIN {name}_lgw g ON g.day = x.day),
{name}_pw AS (SELECT s.team, s.day, p.player, {sums} FROM spine s JOIN {name}_pd p ON p.team = s.team AND p.day BETWEEN s.day - 7 AND s.day - 1 GROUP BY 1, 2, 3),
{name}_top AS (SELECT * FROM (SELECT x.*, ROW_NUMBER() OVER (PARTITION BY team, day ORDER BY {active} DESC, player) AS rn FROM {name}_pw x) WHERE rn <= 5),
{name}_five AS (SELECT team, day, {five} FROM (SELECT x.team, x.day, {micro} FROM {name}_top x JOIN {name}_lgw g ON g.day = x.day) GROUP BY 1, 2)"""


TABLE_SQL = TEAM_GAMES_SQL + f""", k AS (SELECT game_pk, game_date AS day, season, offense_team, defense_team, is_home, runs_scored, runs_allowed
  FROM tg WHERE runs_scored <> runs_allowed AND offense_team IS NOT NULL AND defense_team IS NOT NULL),
pa AS (SELECT g.game_date AS day, g.game_year AS season, CASE WHEN l_linestatus = 'O' THEN away_team ELSE home_team END AS offense_team,
              CASE WHEN l_linestatus = 'O' THEN home_team ELSE away_team END AS defense_team, l_partkey AS batter, l_suppkey AS pitcher,
              {', '.join(COUNTER_COLS)}
       FROM lineitem JOIN games g ON g.game_pk = l_orderkey WHERE home_team IS NOT NULL AND away_team IS NOT NULL),
spine AS (SELECT offense_team AS team, season, day, COUNT(*) AS games, SUM(runs_scored) AS runs FROM k GROUP BY 1, 2, 3),
total AS (SELECT s.team, s.day, SUM(p.games) AS games, SUM(p.runs) AS runs FROM spine s JOIN spine p ON p.team = s.team AND p.season = s.season AND p.day < s.day GROUP BY 1, 2),
{_side_sql('h', 'offense_team', 'batter', TF.HIT_COUNTERS, TF.HITTING, TF.HIT_WEEK, 'pa')},
{_side_sql('p', 'defense_team', 'pitcher', TF.PITCH_COUNTERS, TF.PITCHING, TF.PITCH_WEEK, 'outs')},
ft AS (
SELECT k.game_pk, k.day, k.season, k.offense_team, k.defense_team, k.is_home,
       CAST(COALESCE(total.games, 0) AS BIGINT) AS total_games, CAST(COALESCE(total.runs, 0) AS BIGINT) AS total_runs,
       {', '.join(f'{c}' for c in TF.FEATURES)}, CAST(k.runs_scored AS BIGINT) AS runs_scored, CAST(k.runs_scored > k.runs_allowed AS INTEGER) AS win
FROM k LEFT JOIN total ON total.team = k.offense_team AND total.day = k.day
LEFT JOIN h_std ON h_std.team = k.offense_team AND h_std.day = k.day LEFT JOIN h_week ON h_week.team = k.offense_team AND h_week.day = k.day
LEFT JOIN h_five ON h_five.team = k.offense_team AND h_five.day = k.day
LEFT JOIN p_std ON p_std.team = k.defense_team AND p_std.day = k.day LEFT JOIN p_week ON p_week.team = k.defense_team AND p_week.day = k.day
LEFT JOIN p_five ON p_five.team = k.defense_team AND p_five.day = k.day)
"""
