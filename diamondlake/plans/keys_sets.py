"""Keys, dedup, set operations, next-state window and the star-schema build (Q9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.operators import keys as K
from diamondlake.operators.projection import filter_not_in
from diamondlake.operators.windows import lead_value
from diamondlake.plans import standins as S
from diamondlake.plans.catalog import register
from diamondlake.sources.tables import load

PITCH_KEY = ["game_pk", "at_bat_number", "pitch_number", "pitcher", "batter", "balls", "strikes"]
PLAY_KEY = ["game_pk", "at_bat_number", "pitcher", "batter"]
HIT_KEY = ["game_pk", "at_bat_number", "pitch_number", "pitcher", "batter"]
W = f"WITH {S.FEED_SQL.strip()}\n"


def _cat(cols, sep="-"):
    return f"concat_ws('{sep}', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in cols) + ")"


@register("key_concat", W + f"SELECT game_pk, pitch_number, {_cat(PITCH_KEY)} AS pitch_id FROM feed")
def key_concat(spark, d):
    """K1: composite natural key of seven columns."""
    f = S.pitch_feed_df(spark, d)
    return f.select("game_pk", "pitch_number", K.key_concat(PITCH_KEY).alias("pitch_id"))


@register("key_conditional", W + f"""
SELECT game_pk, pitch_number, CASE WHEN events IS NOT NULL THEN {_cat(PLAY_KEY)} END AS play_id,
       CASE WHEN type = 'X' THEN {_cat(HIT_KEY)} END AS hit_id FROM feed""")
def key_conditional(spark, d):
    """K2: play id only where an event happened; hit id only for balls in play."""
    f = S.pitch_feed_df(spark, d)
    return f.select("game_pk", "pitch_number", K.key_conditional(F.col("events").isNotNull(), PLAY_KEY).alias("play_id"),
                    K.key_conditional(F.col("type") == "X", HIT_KEY).alias("hit_id"))


BASES_SQL = ("concat_ws('-', CAST(CAST(on_1b IS NOT NULL AS INTEGER) AS VARCHAR), "
             "CAST(CAST(on_2b IS NOT NULL AS INTEGER) AS VARCHAR), CAST(CAST(on_3b IS NOT NULL AS INTEGER) AS VARCHAR))")


@register("state_encode", W + f"""
SELECT game_pk, pitch_number, {_cat(['balls', 'strikes'])} AS count_state, {BASES_SQL} AS bases FROM feed""")
def state_encode(spark, d):
    """K3: count state 'b-s' and base occupancy '1-0-1'."""
    f = S.pitch_feed_df(spark, d)
    return f.select("game_pk", "pitch_number", K.state_encode(["balls", "strikes"]).alias("count_state"),
                    K.state_encode(["on_1b", "on_2b", "on_3b"], presence=True).alias("bases"))


@register("key_collision_audit", W + f"""
SELECT COUNT(DISTINCT ({', '.join(PITCH_KEY)})) AS distinct_tuples, COUNT(DISTINCT {_cat(PITCH_KEY, '')}) AS distinct_keys,
       COUNT(DISTINCT ({', '.join(PITCH_KEY)})) - COUNT(DISTINCT {_cat(PITCH_KEY, '')}) AS collisions FROM feed""")
def key_collision_audit(spark, d):
    """K4: do undelimited keys merge distinct tuples?"""
    return K.key_collision_audit(S.pitch_feed_df(spark, d), PITCH_KEY, sep="")


LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


@register("dedup_keep_first", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LI_ORDER)}) AS rn
  FROM lineitem) t WHERE rn = 1""")
def dedup_keep_first(spark, d):
    """K5: one row per (order, line number), the first by a total order."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LI_ORDER)
    return K.dedup_keep_first(li, ["l_orderkey", "l_linenumber"], LI_ORDER)


@register("dedup_full", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_full(spark, d):
    """K6: fully duplicate rows removed."""
    return K.dedup_full(load(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))


@register("union_all", """
SELECT o_orderkey, o_orderdate, 'regular' AS part FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_orderdate, 'post' AS part FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def union_all(spark, d):
    """UNION ALL by name of two overlapping date slices."""
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    a = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).withColumn("part", F.lit("regular"))
    b = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp")).withColumn("part", F.lit("post"))
    return K.union_all([a, b])


@register("except_keys", """
SELECT o_orderkey, o_orderdate FROM orders f WHERE o_orderdate >= TIMESTAMP '1998-01-01'
AND NOT EXISTS (SELECT 1 FROM orders l WHERE l.o_orderdate < TIMESTAMP '1999-01-01' AND l.o_orderkey = f.o_orderkey)""")
def except_keys(spark, d):
    """New keys only (left anti join against the loaded keys)."""
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    feed = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    loaded = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))
    return K.except_keys(feed, loaded, ["o_orderkey"])


MIRROR_SQL = """
SELECT game_pk, game_date, home_team AS offense_team, away_team AS defense_team, home_score AS runs_scored,
       away_score AS runs_allowed, TRUE AS is_home FROM games
UNION ALL
SELECT game_pk, game_date, away_team, home_team, away_score, home_score, FALSE FROM games"""


def mirrored_games(spark, d, games=None):
    g = S.games_df(spark, d) if games is None else games
    return K.mirror_rows(g, ["game_pk", "game_date"], [
        {"offense_team": "home_team", "defense_team": "away_team", "runs_scored": "home_score",
         "runs_allowed": "away_score", "is_home": F.lit(True)},
        {"offense_team": "away_team", "defense_team": "home_team", "runs_scored": "away_score",
         "runs_allowed": "home_score", "is_home": F.lit(False)}])


@register("mirror_rows", f"WITH {S.GAMES_SQL.strip()}\n{MIRROR_SQL}")
def mirror_rows(spark, d):
    """Each game as two team-perspective rows (one explode, no union)."""
    return mirrored_games(spark, d)


@register("win_lead_state", W + f"""
SELECT game_pk, at_bat_number, pitch_number, {BASES_SQL} AS bases,
       LEAD({BASES_SQL}) OVER (PARTITION BY game_pk ORDER BY at_bat_number, pitch_number) AS bases_after FROM feed""")
def win_lead_state(spark, d):
    """Next base state within the game (window per game, bounded by game length)."""
    f = S.pitch_feed_df(spark, d).withColumn("bases", K.state_encode(["on_1b", "on_2b", "on_3b"], presence=True))
    return lead_value(f, ["game_pk"], ["at_bat_number", "pitch_number"], "bases", "bases_after").select(
        "game_pk", "at_bat_number", "pitch_number", "bases", "bases_after")


# ---------------------------------------------------------------- Q9 star schema from one raw feed

def _regular(f):
    return filter_not_in(f, "game_type", ["S", "E"])


def _feed(spark, d, feed=None):
    return feed if feed is not None else _regular(S.pitch_feed_df(spark, d))


REG = "FROM feed WHERE (game_type NOT IN ('S', 'E') OR game_type IS NULL)"


@register("q_star_game", W + f"""
SELECT DISTINCT game_pk, game_date, game_type, home_team, away_team, game_year {REG}""")
def q_star_game(spark, d, feed=None):
    """Q9 game dim: one row per game of the kept game types."""
    f = _feed(spark, d, feed).select("game_pk", "game_date", "game_type", "home_team", "away_team",
                                                   "game_year")
    return K.dedup_keep_first(f, ["game_pk"], ["game_date", "game_type", "home_team", "away_team", "game_year"])


@register("q_star_pitcher", W + f"""
SELECT DISTINCT f.pitcher AS pitcher_id, s.s_name AS pitcher_name
FROM (SELECT DISTINCT pitcher {REG}) f LEFT JOIN supplier s ON s.s_suppkey = f.pitcher""")
def q_star_pitcher(spark, d, feed=None):
    """Q9 pitcher dim."""
    p = _feed(spark, d, feed).select(F.col("pitcher").alias("pitcher_id")).distinct()
    sup = load(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("pitcher_name"))
    return p.join(sup, p.pitcher_id == sup.s_suppkey, "left").select("pitcher_id", "pitcher_name")


@register("q_star_hitter", W + f"""
SELECT f.batter AS hitter_id, p.p_name AS hitter_name
FROM (SELECT DISTINCT batter {REG}) f LEFT JOIN part p ON p.p_partkey = f.batter""")
def q_star_hitter(spark, d, feed=None):
    """Q9 hitter dim."""
    b = _feed(spark, d, feed).select(F.col("batter").alias("hitter_id")).distinct()
    part = load(spark, d, "part").select("p_partkey", F.col("p_name").alias("hitter_name"))
    return b.join(part, b.hitter_id == part.p_partkey, "left").select("hitter_id", "hitter_name")


@register("q_star_hit", W + f"""
SELECT hit_id, game_pk, batter, launch_speed FROM (
  SELECT {_cat(HIT_KEY)} AS hit_id, game_pk, batter, release_speed AS launch_speed,
         ROW_NUMBER() OVER (PARTITION BY {_cat(HIT_KEY)} ORDER BY pitch_number, release_spin_rate) AS rn
  {REG} AND type = 'X') t WHERE rn = 1""")
def q_star_hit(spark, d, feed=None):
    """Q9 hit table: balls in play keyed by the conditional hit id, deduplicated."""
    f = _feed(spark, d, feed).filter(F.col("type") == "X").select(
        K.key_conditional(F.col("type") == "X", HIT_KEY).alias("hit_id"), "game_pk", "batter",
        F.col("release_speed").alias("launch_speed"), "pitch_number", "release_spin_rate")
    return K.dedup_keep_first(f, ["hit_id"], ["pitch_number", "release_spin_rate"]).select(
        "hit_id", "game_pk", "batter", "launch_speed")


@register("q_star_play", W + f"""
SELECT play_id, game_pk, events, bases, bases_after, outs_when_up FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY play_id ORDER BY pitch_number) AS rn FROM (
    SELECT CASE WHEN events IS NOT NULL THEN {_cat(PLAY_KEY)} END AS play_id, game_pk, events, pitch_number,
           outs_when_up, {BASES_SQL} AS bases,
           LEAD({BASES_SQL}) OVER (PARTITION BY game_pk ORDER BY at_bat_number, pitch_number) AS bases_after
    {REG}) a WHERE play_id IS NOT NULL) t WHERE rn = 1""")
def q_star_play(spark, d, feed=None):
    """Q9 play table: plays with an event, base state before and after, dedup on play id."""
    f = _feed(spark, d, feed).withColumn(
        "bases", K.state_encode(["on_1b", "on_2b", "on_3b"], presence=True))
    f = lead_value(f, ["game_pk"], ["at_bat_number", "pitch_number"], "bases", "bases_after")
    f = f.withColumn("play_id", K.key_conditional(F.col("events").isNotNull(), PLAY_KEY)).filter(
        F.col("play_id").isNotNull()).select("play_id", "game_pk", "events", "bases", "bases_after", "outs_when_up",
                                             "pitch_number")
    return K.dedup_keep_first(f, ["play_id"], ["pitch_number"]).drop("pitch_number")


@register("q_star_pitch", W + f"""
SELECT pitch_id, game_id, pitcher_id, batter_id, play_id, hit_id, count_state, release_speed, pitch_type FROM (
  SELECT {_cat(PITCH_KEY)} AS pitch_id, game_pk AS game_id, pitcher AS pitcher_id, batter AS batter_id,
         CASE WHEN events IS NOT NULL THEN {_cat(PLAY_KEY)} END AS play_id,
         CASE WHEN type = 'X' THEN {_cat(HIT_KEY)} END AS hit_id,
         {_cat(['balls', 'strikes'])} AS count_state, release_speed, pitch_type,
         ROW_NUMBER() OVER (PARTITION BY {_cat(PITCH_KEY)} ORDER BY release_spin_rate, shipped) AS rn
  {REG}) t WHERE rn = 1""")
def q_star_pitch(spark, d, feed=None):
    """Q9 pitch fact keyed by the seven-part pitch id, with play/hit foreign keys."""
    f = _feed(spark, d, feed).select(
        K.key_concat(PITCH_KEY).alias("pitch_id"), F.col("game_pk").alias("game_id"),
        F.col("pitcher").alias("pitcher_id"), F.col("batter").alias("batter_id"),
        K.key_conditional(F.col("events").isNotNull(), PLAY_KEY).alias("play_id"),
        K.key_conditional(F.col("type") == "X", HIT_KEY).alias("hit_id"),
        K.state_encode(["balls", "strikes"]).alias("count_state"), "release_speed", "pitch_type",
        "release_spin_rate", "shipped")
    return K.dedup_keep_first(f, ["pitch_id"], ["release_spin_rate", "shipped"]).drop("release_spin_rate", "shipped")


def build_star_schema(spark, d, out_root: str) -> dict:
    """Q9 as a load job: the raw feed is filtered and written once to the shared
    store (the one cached input of the six transforms), then game, pitcher,
    hitter, hit, play and pitch tables are derived from it and written."""
    import os
    from diamondlake.sources.files import cut_lineage_to
    feed = cut_lineage_to(_regular(S.pitch_feed_df(spark, d)), os.path.join(out_root, "_feed"))
    built = {}
    for name, fn in (("game", q_star_game), ("pitcher", q_star_pitcher), ("hitter", q_star_hitter),
                     ("hit", q_star_hit), ("play", q_star_play), ("pitch", q_star_pitch)):
        path = os.path.join(out_root, name)
        fn(spark, d, feed).write.mode("overwrite").parquet(path)
        built[name] = path
    return built
