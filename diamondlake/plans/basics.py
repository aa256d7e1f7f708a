"""Projection, filter and scalar-function queries (P*, F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.functions import scalars as FN
from diamondlake.functions.scalars import round_half_up, round_half_up_sql as R
from diamondlake.operators import projection as P
from diamondlake.plans import standins as S
from diamondlake.plans.catalog import register
from diamondlake.sources.tables import load

RENAME = {"l_orderkey": "game_pk", "l_linenumber": "at_bat_number", "l_partkey": "batter", "l_suppkey": "pitcher",
          "l_quantity": "release_speed", "l_extendedprice": "release_spin_rate", "l_discount": "pfx_x",
          "l_tax": "pfx_z", "l_returnflag": "pitch_type", "l_linestatus": "description", "l_shipdate": "game_date"}


@register("project_rename", "SELECT " + ", ".join(f"{a} AS {b}" for a, b in RENAME.items()) + " FROM lineitem")
def project_rename(spark, d):
    """Column pruning + bulk rename."""
    return P.project_rename(load(spark, d, "lineitem"), RENAME)


RAW_HEADERS = {"event_id": "Event ID", "user_id": "Player/Team", "event_type": "Event Type", "value": "wRC+",
               "props": "Props?"}


@register("normalize_headers", """
SELECT event_id AS event_id, user_id AS player_team, event_type AS event_type, value AS wrc_plus, props AS props
FROM events""")
def normalize_headers(spark, d):
    """Free-form headers ('Player/Team', 'wRC+', 'Props?') normalised by rule."""
    raw = load(spark, d, "events").select(*[F.col(a).alias(b) for a, b in RAW_HEADERS.items()])
    return P.normalize_headers(raw)


@register("drop_cols_like", "SELECT event_id, user_id, event_type FROM events")
def drop_cols_like(spark, d):
    """Drop index-like columns named 'Unnamed: n' (as left by a CSV round trip)."""
    raw = load(spark, d, "events").select(F.col("event_id").alias("Unnamed: 0"), "event_id", "user_id",
                                          "event_type", F.col("value").alias("Unnamed: 5"))
    return P.drop_cols_like(raw)


@register("filter_not_in", f"""
WITH {S.GAMES_SQL.strip()}
SELECT game_pk, game_type FROM games WHERE game_type NOT IN ('S', 'E') OR game_type IS NULL""")
def filter_not_in(spark, d):
    """Drop spring/exhibition games, keeping NULL game types."""
    return P.filter_not_in(S.games_df(spark, d), "game_type", ["S", "E"]).select("game_pk", "game_type")


@register("filter_basic", """
SELECT event_id, user_id, event_type FROM events
WHERE event_type <> 'error' AND event_type <> '' AND props IS NOT NULL""")
def filter_basic(spark, d):
    """P5: not-equal, non-empty and not-null filters."""
    e = load(spark, d, "events")
    return e.filter((F.col("event_type") != "error") & (F.col("event_type") != "") & F.col("props").isNotNull()
                    ).select("event_id", "user_id", "event_type")


CUTOFF = "2024-01-15"


@register("filter_asof_cutoff", f"""
SELECT event_id, user_id, event_type, value FROM events
WHERE event_type = 'click' AND value >= 10 AND ts < TIMESTAMP '{CUTOFF}'""")
def filter_asof_cutoff(spark, d):
    """Multi-column conjunction with a point-in-time cutoff (pushed to the scan)."""
    e = load(spark, d, "events")
    return e.filter((F.col("event_type") == "click") & (F.col("value") >= 10)
                    & (F.col("ts") < F.lit(CUTOFF).cast("timestamp"))).select("event_id", "user_id", "event_type", "value")


@register("filter_date_range", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS game_date, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS game_year
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def filter_date_range(spark, d):
    """season = year written as a date range so it pushes down to Parquet."""
    o = load(spark, d, "orders")
    return o.filter(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp"),
                                                 F.lit("1996-12-31 23:59:59.999999").cast("timestamp"))).select(
        "o_orderkey", F.to_date("o_orderdate").alias("game_date"), F.year("o_orderdate").alias("game_year"))


EXCLUDE_WORDS = ["license", "password", "secret"]


@register("filter_text_exclude", """
SELECT doc_id, source FROM documents
WHERE source LIKE '%src%' AND NOT COALESCE(contains(lower(text), 'license'), FALSE)
  AND NOT COALESCE(contains(lower(text), 'password'), FALSE) AND NOT COALESCE(contains(lower(text), 'secret'), FALSE)""")
def filter_text_exclude(spark, d):
    """LIKE plus case-insensitive word exclusions over whole texts."""
    return P.filter_text_exclude(load(spark, d, "documents"), "text", EXCLUDE_WORDS, like="%src%",
                                 like_col="source").select("doc_id", "source")


@register("filter_known_dims", f"""
WITH {S.GAMES_SQL.strip()}
SELECT game_pk, home_team, away_team, home_score, away_score FROM games
WHERE home_team IN (SELECT n_nationkey FROM nation) AND away_team IN (SELECT n_nationkey FROM nation)
  AND home_score <> away_score""")
def filter_known_dims(spark, d):
    """P10: both teams known (semi joins to the team dim) and the game not tied."""
    g = S.games_df(spark, d)
    nation = F.broadcast(load(spark, d, "nation"))   # team dim: bounded
    out = P.filter_known_dims(g, nation, "n_nationkey", ["home_team", "away_team"], ("home_score", "away_score"))
    return out.select("game_pk", "home_team", "away_team", "home_score", "away_score")


@register("case_side", f"""
WITH {S.FEED_SQL.strip()}
SELECT game_pk, pitch_number, CASE WHEN inning_topbot = 'Top' THEN away_team ELSE home_team END AS offense_team,
       CASE WHEN inning_topbot = 'Top' THEN home_team ELSE away_team END AS defense_team FROM feed""")
def case_side(spark, d):
    """offense/defence team from the inning half."""
    f = P.case_side(S.pitch_feed_df(spark, d), "inning_topbot", "Top", "home_team", "away_team")
    return f.select("game_pk", "pitch_number", "offense_team", "defense_team")


@register("guarded_ratio", f"""
SELECT user_id, CAST(ts AS DATE) AS game_date,
       CASE WHEN COUNT(*) FILTER (WHERE event_type = 'purchase') > 0
            THEN {R("SUM(value) / COUNT(*) FILTER (WHERE event_type = 'purchase')", 4)} END AS value_per_hr
FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def guarded_ratio(spark, d):
    """CASE-guarded division -> NULL on a zero denominator."""
    e = load(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("game_date")).agg(
        F.sum("value").alias("v"), F.count_if(F.col("event_type") == "purchase").alias("n"))
    return e.select("user_id", "game_date", FN.safe_ratio("v", "n", 4).alias("value_per_hr"))


@register("map_lookup_default", f"""
SELECT event_id, {S.map_sql(S.EVENT_NAME, 'event_type')} AS event_name,
       {S.map_sql(S.OUTS_BY_EVENT, S.map_sql(S.EVENT_NAME, 'event_type'), '0')} AS outs,
       CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 4 WHEN 'signup' THEN 0.5 ELSE 0 END AS DOUBLE) AS hit_value
FROM events""")
def map_lookup_default(spark, d):
    """Dictionary lookups with defaults (event -> outs, event -> hit value)."""
    e = load(spark, d, "events").withColumn("event_name", P.map_lookup("event_type", S.EVENT_NAME))
    return e.select("event_id", "event_name", P.map_lookup("event_name", S.OUTS_BY_EVENT, 0).alias("outs"),
                    P.map_lookup("event_name", S.HIT_VALUE, 0.0).alias("hit_value"))


@register("bool_flags", f"""
WITH {S.GAMES_SQL.strip()}
SELECT game_pk, home_score > away_score AS home_team_won FROM games""")
def bool_flags(spark, d):
    """Win flag from scores (NULL scores -> NULL flag)."""
    g = S.games_df(spark, d)
    return g.select("game_pk", (F.col("home_score") > F.col("away_score")).alias("home_team_won"))


@register("derived_arith", f"""
WITH b AS (SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'view') AS num_doubles,
                  COUNT(*) FILTER (WHERE event_type = 'purchase') AS num_hrs, COUNT(*) AS games,
                  SUM(value) AS runs FROM events GROUP BY user_id)
SELECT user_id, num_doubles + num_hrs AS xbh, {R('runs / games', 4)} AS runs_per_game FROM b""")
def derived_arith(spark, d):
    """Arithmetic columns (extra-base hits, runs per game)."""
    b = load(spark, d, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("num_doubles"),
        F.count_if(F.col("event_type") == "purchase").alias("num_hrs"),
        F.count(F.lit(1)).alias("games"), F.sum("value").alias("runs"))
    return b.select("user_id", (F.col("num_doubles") + F.col("num_hrs")).alias("xbh"),
                    round_half_up(F.col("runs") / F.col("games"), 4).alias("runs_per_game"))


@register("cast_columns", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""")
def cast_columns(spark, d):
    """Type casts over a column list."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey",
                                        F.substring("o_orderpriority", 1, 1).alias("o_orderpriority"), "o_orderdate")
    return P.cast_columns(o, {"o_orderkey": "string", "o_custkey": "int", "o_orderpriority": "int",
                              "o_orderdate": "date"})


@register("distinct_dropna", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL")
def distinct_dropna(spark, d):
    """DISTINCT projection with NULL rows dropped."""
    return P.distinct_dropna(load(spark, d, "orders"), ["o_custkey", "o_orderpriority"])


# ---------------------------------------------------------------- scalar functions

@register("fn_anchor_text", r"""
SELECT page_id, NULLIF(regexp_extract(html, '(?s)<a(\s[^>]*)?>(.*?)</a>', 2), '') AS anchor FROM pages""")
def fn_anchor_text(spark, d):
    """text of the first link of the whole page."""
    return load(spark, d, "pages").select("page_id", FN.link_text("html").alias("anchor"))


@register("fn_swap_name", """
SELECT conv_id, turn, CASE WHEN instr(text, ',') > 0
  THEN trim(substr(text, instr(text, ',') + 1)) || ' ' || trim(split_part(text, ',', 1)) ELSE text END AS swapped
FROM conversations""")
def fn_swap_name(spark, d):
    """'Last, First' -> 'First Last' on whole texts."""
    return load(spark, d, "conversations").select("conv_id", "turn", FN.swap_name("text").alias("swapped"))


@register("fn_strip_accents", """
SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
  translate(strip_accents(text), 'øØłŁđĐðÐħĦŧŦıſ', 'oOlLdDdDhHtTis'),
  'ß', 'ss'), 'ẞ', 'SS'), 'æ', 'ae'), 'Æ', 'AE'), 'œ', 'oe'), 'Œ', 'OE'), 'þ', 'th'), 'Þ', 'Th'), 'ĳ', 'ij'), 'Ĳ', 'IJ') AS folded
FROM documents""")
def fn_strip_accents(spark, d):
    """accent folding of whole documents."""
    return load(spark, d, "documents").select("doc_id", FN.strip_accents("text").alias("folded"))


@register("fn_first_two_words", r"""
SELECT doc_id, array_to_string(string_split_regex(trim(text), '\s+')[1:2], ' ') AS first_two FROM documents""")
def fn_first_two_words(spark, d):
    """first two words."""
    return load(spark, d, "documents").select("doc_id", FN.first_two_words("text").alias("first_two"))


@register("fn_percent", """
SELECT event_id, CAST(regexp_replace(CAST(value AS VARCHAR) || '%', '%$', '') AS DOUBLE) / 100.0 AS fraction FROM events""")
def fn_percent(spark, d):
    """'12.3%' text -> 0.123."""
    e = load(spark, d, "events").select("event_id", F.concat(F.col("value").cast("string"), F.lit("%")).alias("pct"))
    return e.select("event_id", FN.percent_to_fraction("pct").alias("fraction"))


@register("fn_dates", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%Y-%m-%d') AS d_str,
       CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS yr,
       CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 7 DAY AS DATE) AS plus_7,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 14 DAY AS DATE) AS minus_2w
FROM orders""")
def fn_dates(spark, d):
    """F8: parse/format, year, day difference, +/- days and weeks."""
    o = load(spark, d, "orders").withColumn("d", F.to_date("o_orderdate"))
    return o.select("o_orderkey", "d", F.date_format("d", "yyyy-MM-dd").alias("d_str"), F.year("d").alias("yr"),
                    F.datediff("d", F.lit("1995-01-01").cast("date")).alias("days_since"),
                    F.date_add("d", 7).alias("plus_7"), F.date_sub("d", 14).alias("minus_2w"))


@register("fn_round_coalesce", f"""
SELECT o_orderkey, {R('o_totalprice / 1000', 2)} AS price_k, COALESCE(o_orderpriority, 'unknown') AS priority,
       TRY_CAST(o_custkey AS INTEGER) AS custkey, CAST(EXTRACT(MONTH FROM o_orderdate) AS INTEGER) AS month
FROM orders""")
def fn_round_coalesce(spark, d):
    """ROUND / COALESCE / CAST / EXTRACT."""
    o = load(spark, d, "orders")
    return o.select("o_orderkey", round_half_up(F.col("o_totalprice") / 1000, 2).alias("price_k"),
                    F.coalesce("o_orderpriority", F.lit("unknown")).alias("priority"),
                    F.col("o_custkey").try_cast("int").alias("custkey"), F.month("o_orderdate").alias("month"))


@register("winner_tiebreak", f"""
WITH {S.GAMES_SQL.strip()}
SELECT game_pk, CASE WHEN home_score > away_score THEN home_team WHEN away_score > home_score THEN away_team
                     WHEN home_qty > away_qty THEN home_team WHEN away_qty > home_qty THEN away_team END AS predicted_winner
FROM games""")
def winner_tiebreak(spark, d):
    """winner by score, tie -> by secondary total, tie -> NULL."""
    g = S.games_df(spark, d)
    return g.select("game_pk", FN.winner_tiebreak("home_team", "away_team", "home_score", "away_score",
                                                  "home_qty", "away_qty").alias("predicted_winner"))


@register("fn_json_field", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def fn_json_field(spark, d):
    """JSON field access."""
    return load(spark, d, "events").select("event_id", FN.json_int_field("props", "k").alias("k"))
