"""Team-game windows (W7-W10), sorting, sampling and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up_sql as R
from diamondlake.operators import ordering as O
from diamondlake.operators import windows as WN
from diamondlake.operators.aggregates import majority_vote
from diamondlake.plans import standins as S
from diamondlake.plans.catalog import register
from diamondlake.plans.keys_sets import MIRROR_SQL, mirrored_games
from diamondlake.sources.tables import load

TEAM_ORDER = ["game_date", "game_pk", "is_home"]   # total order inside one team's schedule


def team_games(spark, d, games=None):
    """One row per (team, game) with a known score."""
    return (mirrored_games(spark, d, games).filter(F.col("runs_scored").isNotNull())
            .withColumn("win", (F.col("runs_scored") > F.col("runs_allowed")).cast("int"))
            .withColumn("season", F.year("game_date")).withColumn("one", F.lit(1)))


TEAM_GAMES_SQL = f"""WITH {S.GAMES_SQL.strip()},
mirrored AS ({MIRROR_SQL}),
tg AS (SELECT *, CAST(runs_scored > runs_allowed AS INTEGER) AS win,
              CAST(EXTRACT(YEAR FROM game_date) AS INTEGER) AS season, 1 AS one
       FROM mirrored WHERE runs_scored IS NOT NULL)
"""
TW = "PARTITION BY offense_team ORDER BY game_date, game_pk, is_home"


@register("win_season_to_date", TEAM_GAMES_SQL + f"""
SELECT offense_team, game_pk, is_home, game_date,
       {R(f'CAST(SUM(win) OVER (PARTITION BY offense_team, season ORDER BY game_date, game_pk, is_home ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / SUM(one) OVER (PARTITION BY offense_team, season ORDER BY game_date, game_pk, is_home ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 4)} AS std_win_pct
FROM tg""")
def win_season_to_date(spark, d):
    """Season-to-date win rate per team (as written: includes the game itself)."""
    tg = team_games(spark, d)
    out = WN.running_ratio(tg, ["offense_team", "season"], TEAM_ORDER, "win", "one", "std_win_pct", skew_safe=True)
    return out.select("offense_team", "game_pk", "is_home", "game_date", "std_win_pct")


@register("win_trailing_7d", TEAM_GAMES_SQL + f"""
SELECT offense_team, game_pk, is_home, game_date,
       {R('CAST(SUM(runs_scored) OVER w AS DOUBLE) / SUM(one) OVER w', 4)} AS runs_per_game_7d
FROM tg WINDOW w AS (PARTITION BY offense_team ORDER BY game_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""")
def win_trailing_7d(spark, d):
    """Trailing [d-7, d] runs per game per team."""
    tg = team_games(spark, d)
    out = WN.trailing_days_ratio(tg, "offense_team", "game_date", "runs_scored", "one", "runs_per_game_7d", days=7)
    return out.select("offense_team", "game_pk", "is_home", "game_date", "runs_per_game_7d")


@register("win_rolling_10", TEAM_GAMES_SQL + f"""
SELECT offense_team, game_pk, is_home, CAST(SUM(win) OVER ({TW} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS BIGINT) AS wins_last_10
FROM tg""")
def win_rolling_10(spark, d):
    """Rolling count of wins over the last ten games, min_periods 1."""
    out = WN.rolling_sum(team_games(spark, d), "offense_team", TEAM_ORDER, "win", "wins_last_10", rows=10,
                         skew_safe=True)
    return out.select("offense_team", "game_pk", "is_home", F.col("wins_last_10").cast("bigint").alias("wins_last_10"))


def predictions_vs_results(spark, d):
    """Per game: simulated-trial majority prediction vs the actual winner."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = load(spark, d, "part").select("p_partkey", "p_size")
    pred = majority_vote(li.join(part, li.l_partkey == part.p_partkey), "l_orderkey", "l_quantity", "p_size")
    g = S.games_df(spark, d).select("game_pk", "game_date", (F.col("home_score") > F.col("away_score")).alias("actual"))
    j = g.join(pred, g.game_pk == pred.l_orderkey)
    return j.select("game_pk", "game_date", F.col("home_predicted_win").alias("predicted"), "actual",
                    (F.col("home_predicted_win") == F.col("actual")).alias("correct"))


PRED_SQL = f"""WITH {S.GAMES_SQL.strip()},
mv AS (SELECT l.l_orderkey, COUNT(*) FILTER (WHERE l.l_quantity > p.p_size) > COUNT(*) FILTER (WHERE p.p_size > l.l_quantity) AS predicted
       FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey),
pr AS (SELECT g.game_pk, g.game_date, mv.predicted, g.home_score > g.away_score AS actual,
              mv.predicted = (g.home_score > g.away_score) AS correct
       FROM games g JOIN mv ON mv.l_orderkey = g.game_pk)
"""


@register("win_running_accuracy", PRED_SQL + f"""
SELECT game_pk, game_date, COUNT(*) OVER w AS games_so_far, CAST(SUM(CAST(correct AS INTEGER)) OVER w AS BIGINT) AS correct_so_far,
       {R('CAST(SUM(CAST(correct AS INTEGER)) OVER w AS DOUBLE) / COUNT(*) OVER w', 4)} AS running_accuracy
FROM pr WINDOW w AS (ORDER BY game_date, game_pk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def win_running_accuracy(spark, d):
    """Running backtest accuracy in game order without one global sort."""
    out = WN.running_accuracy(predictions_vs_results(spark, d), "game_date", "game_pk", "correct", skew_safe=True)
    return out.select("game_pk", "game_date", F.col("games_so_far").cast("bigint").alias("games_so_far"),
                      F.col("correct_so_far").cast("bigint").alias("correct_so_far"), "running_accuracy")


@register("backtest_accuracy", PRED_SQL + f"""
SELECT COUNT(*) AS games, COUNT(*) FILTER (WHERE correct) AS correct_games,
       {R('CAST(COUNT(*) FILTER (WHERE correct) AS DOUBLE) / COUNT(*)', 4)} AS accuracy,
       COUNT(*) FILTER (WHERE predicted AND actual) AS tp, COUNT(*) FILTER (WHERE predicted AND NOT actual) AS fp
FROM pr""")
def backtest_accuracy(spark, d):
    """M7: predicted vs actual per game, overall accuracy and confusion counts."""
    from diamondlake.functions.scalars import round_half_up
    pr = predictions_vs_results(spark, d)
    return pr.agg(F.count(F.lit(1)).alias("games"), F.count_if("correct").alias("correct_games"),
                  round_half_up(F.try_divide(F.count_if("correct"), F.count(F.lit(1))), 4).alias("accuracy"),
                  F.count_if(F.col("predicted") & F.col("actual")).alias("tp"),
                  F.count_if(F.col("predicted") & ~F.col("actual")).alias("fp"))


# ---------------------------------------------------------------- O1-O7

@register("sort_nulls", f"WITH {S.GAMES_SQL.strip()}\nSELECT game_pk, home_score FROM games ORDER BY home_score DESC NULLS FIRST, game_pk")
def sort_nulls(spark, d):
    """O1: DESC with NULLs first plus tiebreak."""
    return O.sort_nulls(S.games_df(spark, d).select("game_pk", "home_score"), "home_score", ["game_pk"])


@register("top_n", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def top_n(spark, d):
    """O2: top 10 plays by value (top-k is the feature)."""
    e = load(spark, d, "events").select("event_id", "user_id", "value")
    return O.top_n(e, [F.desc("value"), F.asc("event_id")], 10)


@register("topk_per_group_mean", f"""
WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal,
                  ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer),
o AS (SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) / 1000 AS spend FROM orders GROUP BY o_custkey),
t AS (SELECT c.c_nationkey, c.c_acctbal, o.n_orders, o.spend FROM c LEFT JOIN o ON o.o_custkey = c.c_custkey WHERE rn <= 5)
SELECT c_nationkey, COUNT(*) AS n_top, {R('AVG(c_acctbal)', 4)} AS avg_c_acctbal, {R('AVG(n_orders)', 4)} AS avg_n_orders,
       {R('AVG(spend)', 4)} AS avg_spend
FROM t GROUP BY c_nationkey""")
def topk_per_group_mean(spark, d):
    """O3: top-5 players per team, then the mean of their stats."""
    o = load(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                                         (F.sum("o_totalprice") / 1000).alias("spend"))
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    players = c.join(o, c.c_custkey == o.o_custkey, "left")
    return O.topk_per_group_mean(players, "c_nationkey", [F.desc("c_acctbal"), F.asc("c_custkey")], 5,
                                 ["c_acctbal", "n_orders", "spend"])


@register("latest_value", "SELECT MAX(CAST(o_orderdate AS DATE)) AS latest_date FROM orders")
def latest_value(spark, d):
    """Latest date in the table (a max, not a sort)."""
    return load(spark, d, "orders").agg(F.max(F.to_date("o_orderdate")).alias("latest_date"))


STATES = ["click", "view", "signup", "purchase", "error"]
SAMPLE_CUTOFF = "2024-01-20"


@register("sample_one_per_group", f"""
WITH req AS (SELECT c_custkey AS user_id, s.state FROM customer, (VALUES {', '.join(f"('{s}')" for s in STATES)}) AS s(state)),
hist AS (SELECT user_id, event_type, event_id, value,
                ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY md5(CAST(event_id AS VARCHAR) || '42')) AS rn
         FROM events WHERE ts < TIMESTAMP '{SAMPLE_CUTOFF}')
SELECT r.user_id, r.state, h.event_id, COALESCE(h.value, 0.0) AS value
FROM req r LEFT JOIN hist h ON h.user_id = r.user_id AND h.event_type = r.state AND h.rn = 1""")
def sample_one_per_group(spark, d):
    """One seeded random historical row per (player, state) before a cutoff;
    states without history get the default row (value 0)."""
    hist = load(spark, d, "events").filter(F.col("ts") < F.lit(SAMPLE_CUTOFF).cast("timestamp"))
    pick = O.sample_one_per_group(hist, ["user_id", "event_type"], ["event_id"], ["value"], seed=42)
    req = load(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                            F.explode(F.array(*[F.lit(s) for s in STATES])).alias("state"))
    j = req.join(pick, (req.user_id == pick.user_id) & (req.state == pick.event_type), "left")
    return j.select(req.user_id, "state", "event_id", F.coalesce("value", F.lit(0.0)).alias("value"))


@register("split_hash", """
SELECT o_orderkey, CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR) || '42'), 1, 4) < 'cccd' THEN 'train' ELSE 'test' END AS split
FROM orders""")
def split_hash(spark, d):
    """Stable 80/20 hash split."""
    return O.split_hash(load(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@register("split_chronological", TEAM_GAMES_SQL + f"""
SELECT offense_team, game_pk, is_home,
       CASE WHEN ROW_NUMBER() OVER ({TW}) <= FLOOR(COUNT(*) OVER (PARTITION BY offense_team) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM tg""")
def split_chronological(spark, d):
    """Chronological 80/20 split per team."""
    out = O.split_chronological(team_games(spark, d), "offense_team", TEAM_ORDER, skew_safe=True)
    return out.select("offense_team", "game_pk", "is_home", "split")
