"""Role mapping of the driver's test tables onto the play-by-play model.

Fixed values (stand-in vocabulary and season weights):

event_type -> baseball role
    click    = single
    view     = double
    purchase = home run
    signup   = walk
    error    = out (at bat, no hit)
    (no triple, hit-by-pitch or sacrifice-fly events exist in the stand-in feed)

Season weights for the weighted on-base rate, one row per season
(season, wbb, whbp, w1b, w2b, w3b, whr):
    1995 0.70 0.73 0.89 1.26 1.60 2.07
    1996 0.70 0.73 0.89 1.26 1.60 2.07
    1997 0.70 0.73 0.89 1.26 1.60 2.06
    1998 0.70 0.73 0.89 1.26 1.59 2.05
    1999 0.70 0.73 0.89 1.26 1.59 2.05
    2000 0.70 0.73 0.89 1.26 1.59 2.06
    2001 0.70 0.73 0.89 1.26 1.60 2.06
    2024 0.69 0.72 0.88 1.25 1.59 2.04
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from diamondlake.functions.sqltext import sql_in
from diamondlake.operators.aggregates import NOT_NULL

SINGLE = ["click"]
DOUBLE = ["view"]
TRIPLE: list[str] = []
HOME_RUN = ["purchase"]
WALK = ["signup"]
HIT_BY_PITCH: list[str] = []
SAC_FLY: list[str] = []
OUT = ["error"]

HITS = HOME_RUN + TRIPLE + DOUBLE + SINGLE
AT_BAT = HITS + OUT
ON_BASE = HITS + WALK + HIT_BY_PITCH
WALKS = WALK + HIT_BY_PITCH

# "cycle" stand-in: four distinct event kinds, signup in the triple's place
CYCLE = {"num_singles": ["click"], "num_doubles": ["view"], "num_triples": ["signup"], "num_hrs": ["purchase"]}

BATTING_CATEGORIES = {
    "hit_count": HITS, "total_ab": AT_BAT, "num_obp": ON_BASE, "sf": SAC_FLY, "walks": WALKS,
    "only_walks": WALK, "only_hit_by_pitch": HIT_BY_PITCH, "num_singles": SINGLE,
    "num_doubles": DOUBLE, "num_triples": TRIPLE, "num_hrs": HOME_RUN, "num_pa": NOT_NULL,
}

WEIGHT_COLUMNS = ["season", "wbb", "whbp", "w1b", "w2b", "w3b", "whr"]
SEASON_WEIGHTS = [
    (1995, 0.70, 0.73, 0.89, 1.26, 1.60, 2.07),
    (1996, 0.70, 0.73, 0.89, 1.26, 1.60, 2.07),
    (1997, 0.70, 0.73, 0.89, 1.26, 1.60, 2.06),
    (1998, 0.70, 0.73, 0.89, 1.26, 1.59, 2.05),
    (1999, 0.70, 0.73, 0.89, 1.26, 1.59, 2.05),
    (2000, 0.70, 0.73, 0.89, 1.26, 1.59, 2.06),
    (2001, 0.70, 0.73, 0.89, 1.26, 1.60, 2.06),
    (2024, 0.69, 0.72, 0.88, 1.25, 1.59, 2.04),
]


def weights_df(spark: SparkSession):
    return spark.createDataFrame(SEASON_WEIGHTS, "season int, wbb double, whbp double, w1b double, "
                                                 "w2b double, w3b double, whr double")


def weights_sql() -> str:
    rows = ", ".join("(" + ", ".join(str(v) for v in r) + ")" for r in SEASON_WEIGHTS)
    cols = ", ".join(["CAST(season AS INTEGER) AS season"] + [f"CAST({c} AS DOUBLE) AS {c}" for c in WEIGHT_COLUMNS[1:]])
    return f"(SELECT {cols} FROM (VALUES {rows}) AS w({', '.join(WEIGHT_COLUMNS)}))"


def batting_counts_sql(col: str = "event_type") -> str:
    parts = []
    for name, spec in BATTING_CATEGORIES.items():
        pred = f"{col} IS NOT NULL" if spec is NOT_NULL else sql_in(col, spec)
        parts.append(f"COUNT(*) FILTER (WHERE {pred}) AS {name}")
    return ",\n       ".join(parts)


# ---------------------------------------------------------------- games (orders as games)
# Order status -> game type (O regular season, F post-season, P spring training).
GAME_TYPE = {"O": "R", "F": "F", "P": "S"}

from diamondlake.functions.vocab import HIT_VALUE, OUTS_BY_EVENT  # noqa: E402,F401  (fixed tables)

# stand-in event_type -> play event name
EVENT_NAME = {"click": "single", "view": "double", "purchase": "home_run", "signup": "walk", "error": "field_out"}

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def games_df(spark, d):
    """One row per game: orders are games; home team = customer's nation, away
    team = nation of the supplier of the game's first line; home/away score =
    number of lines with return flag R / A; qty = quantity on those lines.
    Lines are aggregated per order before joining (one row per order)."""
    from pyspark.sql import functions as F
    from diamondlake.sources.tables import load
    li = load(spark, d, "lineitem").select(*LINE_ORDER, "l_orderkey", "l_returnflag")
    # aggregate lines per order first, then look up one supplier per order
    per = li.groupBy("l_orderkey").agg(
        F.min_by("l_suppkey", F.struct(*LINE_ORDER)).alias("first_suppkey"),
        F.count_if(F.col("l_returnflag") == "R").alias("home_score"),
        F.count_if(F.col("l_returnflag") == "A").alias("away_score"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("home_qty"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0.0)).alias("away_qty"))
    sup = load(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("away_team"))
    per = per.join(sup, per.first_suppkey == sup.s_suppkey, "left").drop("first_suppkey", "s_suppkey")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    cust = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    gtype = F.create_map(*[F.lit(x) for kv in GAME_TYPE.items() for x in kv])
    g = o.join(cust, o.o_custkey == cust.c_custkey).join(per, o.o_orderkey == per.l_orderkey, "left")
    return g.select(F.col("o_orderkey").alias("game_pk"), F.to_date("o_orderdate").alias("game_date"),
                    F.year("o_orderdate").alias("game_year"), gtype[F.col("o_orderstatus")].alias("game_type"),
                    F.col("c_nationkey").alias("home_team"), "away_team", "home_score", "away_score",
                    "home_qty", "away_qty")


GAMES_SQL = """
lines AS (
  SELECT l.l_orderkey, l.l_suppkey, l.l_returnflag, l.l_quantity,
         ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                            l.l_quantity, l.l_extendedprice, l.l_shipdate) AS rn
  FROM lineitem l),
per0 AS (
  SELECT l_orderkey, MAX(CASE WHEN rn = 1 THEN l_suppkey END) AS first_suppkey,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS home_score, COUNT(*) FILTER (WHERE l_returnflag = 'A') AS away_score,
         SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS home_qty,
         SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0 END) AS away_qty
  FROM lines GROUP BY l_orderkey),
per AS (SELECT per0.*, s.s_nationkey AS away_team FROM per0 LEFT JOIN supplier s ON s.s_suppkey = per0.first_suppkey),
games AS (
  SELECT o.o_orderkey AS game_pk, CAST(o.o_orderdate AS DATE) AS game_date,
         CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INTEGER) AS game_year,
         CASE o.o_orderstatus WHEN 'O' THEN 'R' WHEN 'F' THEN 'F' WHEN 'P' THEN 'S' END AS game_type,
         c.c_nationkey AS home_team, p.away_team, p.home_score, p.away_score, p.home_qty, p.away_qty
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN per p ON p.l_orderkey = o.o_orderkey)"""


def map_sql(mapping: dict, expr: str, default="NULL") -> str:
    """CASE rendering of a fixed lookup table for the SQL oracle."""
    from diamondlake.functions.sqltext import lit
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"COALESCE(CASE {expr} {whens} END, {default})"


# ---------------------------------------------------------------- raw pitch feed (lineitem as pitches)

def pitch_feed_df(spark, d):
    """Raw one-row-per-pitch feed: each line of an order is a pitch of that game.
    pitch_number is the line's rank inside its game (a window per game, whose
    size is bounded by the game length)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from diamondlake.sources.tables import load
    li = load(spark, d, "lineitem")
    g = games_df(spark, d).select("game_pk", "game_date", "game_year", "game_type", "home_team", "away_team")
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    ev = F.create_map(F.lit("R"), F.lit("single"), F.lit("A"), F.lit("field_out"))
    f = li.join(g, li.l_orderkey == g.game_pk)
    return f.select(
        "game_pk", "game_date", "game_year", "game_type", "home_team", "away_team",
        F.col("l_suppkey").alias("pitcher"), F.col("l_partkey").alias("batter"),
        F.col("l_linenumber").alias("at_bat_number"), F.row_number().over(w).cast("bigint").alias("pitch_number"),
        F.col("l_linenumber").alias("inning"),
        F.when(F.col("l_linestatus") == "O", "Top").otherwise("Bot").alias("inning_topbot"),
        F.floor(F.col("l_discount") * 30).cast("int").alias("balls"),
        F.floor(F.col("l_tax") * 25).cast("int").alias("strikes"),
        F.floor(F.col("l_quantity") / 17).cast("int").alias("outs_when_up"),
        ev[F.col("l_returnflag")].alias("events"),
        F.when(F.col("l_returnflag") == "R", "X").when(F.col("l_returnflag") == "A", "S").otherwise("B").alias("type"),
        F.when(F.col("l_quantity") > 25, F.col("l_partkey")).alias("on_1b"),
        F.when(F.col("l_discount") > 0.05, F.col("l_suppkey")).alias("on_2b"),
        F.when(F.col("l_tax") > 0.04, F.col("l_partkey")).alias("on_3b"),
        F.col("l_quantity").alias("release_speed"), F.col("l_extendedprice").alias("release_spin_rate"),
        F.col("l_linestatus").alias("pitch_type"), F.col("l_shipdate").alias("shipped"))


FEED_SQL = GAMES_SQL + """,
feed AS (
  SELECT g.game_pk, g.game_date, g.game_year, g.game_type, g.home_team, g.away_team,
         l.l_suppkey AS pitcher, l.l_partkey AS batter, l.l_linenumber AS at_bat_number,
         ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                            l.l_quantity, l.l_extendedprice, l.l_shipdate) AS pitch_number,
         l.l_linenumber AS inning, CASE WHEN l.l_linestatus = 'O' THEN 'Top' ELSE 'Bot' END AS inning_topbot,
         CAST(FLOOR(l.l_discount * 30) AS INTEGER) AS balls, CAST(FLOOR(l.l_tax * 25) AS INTEGER) AS strikes,
         CAST(FLOOR(l.l_quantity / 17) AS INTEGER) AS outs_when_up,
         CASE l.l_returnflag WHEN 'R' THEN 'single' WHEN 'A' THEN 'field_out' END AS events,
         CASE l.l_returnflag WHEN 'R' THEN 'X' WHEN 'A' THEN 'S' ELSE 'B' END AS type,
         CASE WHEN l.l_quantity > 25 THEN l.l_partkey END AS on_1b,
         CASE WHEN l.l_discount > 0.05 THEN l.l_suppkey END AS on_2b,
         CASE WHEN l.l_tax > 0.04 THEN l.l_partkey END AS on_3b,
         l.l_quantity AS release_speed, l.l_extendedprice AS release_spin_rate, l.l_linestatus AS pitch_type,
         l.l_shipdate AS shipped
  FROM lineitem l JOIN games g ON g.game_pk = l.l_orderkey)"""
