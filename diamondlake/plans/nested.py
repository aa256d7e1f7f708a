"""JSON and HTML source queries (S7-S10) over payloads derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from diamondlake.plans import standins as S
from diamondlake.plans.catalog import register
from diamondlake.sources import nested as N
from diamondlake.sources.tables import load

PLAYER_ITEM = (StructType().add("playerid", LongType()).add("Name", StringType())
               .add("PA", LongType()).add("WAR", DoubleType()))


def player_day_payloads(spark, d):
    """One API-style payload per play: ``{"data":[{playerid, Name, PA, WAR}]}``;
    plays of type 'error' return a payload without ``data``."""
    e = load(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    c = load(spark, d, "customer").select("c_custkey", "c_name")
    j = e.join(c, e.user_id == c.c_custkey, "left")
    item = F.struct(F.col("user_id").alias("playerid"),
                    F.concat(F.lit('<a href="/p/'), F.col("user_id").cast("string"), F.lit('">'),
                             F.col("c_name"), F.lit("</a>")).alias("Name"),
                    F.get_json_object("props", "$.k").try_cast("long").alias("PA"), F.col("value").alias("WAR"))
    payload = F.when(F.col("event_type") == "error", F.to_json(F.struct(F.lit("no games").alias("status")))) \
               .otherwise(F.to_json(F.struct(F.array(item).alias("data"))))
    return j.select("event_id", payload.alias("payload"))


@register("json_rows", """
SELECT e.event_id, e.user_id AS player_id, c.c_name AS name, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS pa,
       e.value AS war
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id WHERE e.event_type <> 'error'""")
def json_rows(spark, d):
    """JSON ``data[]`` rows projected to named fields; missing ``data`` -> no rows."""
    rows = N.json_rows(player_day_payloads(spark, d), "payload", PLAYER_ITEM,
                       {"player_id": "playerid", "name_html": "Name", "pa": "PA", "war": "WAR"}, keep=["event_id"])
    return rows.select("event_id", "player_id", N.anchor_text("name_html").alias("name"), "pa", "war")


BATTER = StructType().add("personId", LongType()).add("battingOrder", StringType()).add("name", StringType())
BOX = (StructType()
       .add("teamInfo", StructType().add("home", StructType().add("abbreviation", StringType()))
            .add("away", StructType().add("abbreviation", StringType())))
       .add("homeBatters", ArrayType(BATTER)).add("awayBatters", ArrayType(BATTER)))


def box_scores(spark, d):
    """One box score per game (order): its lines with return flag R bat for the
    home team, A for the away team; person = part key, name = part name; the
    batting order is a hundred times the line's slot on its side, plus 1 for a
    substitute (quantity over 40).  Team abbreviations are the first three
    letters of the teams' nation names.  A game's lineup arrays are bounded by
    the game's number of lines."""
    from pyspark.sql import Window

    li = load(spark, d, "lineitem").filter(F.col("l_returnflag").isin("R", "A"))
    part = load(spark, d, "part").select("p_partkey", "p_name")
    li = li.join(part, li.l_partkey == part.p_partkey, "left")
    w = Window.partitionBy("l_orderkey", "l_returnflag").orderBy(*S.LINE_ORDER)
    li = li.withColumn("slot", F.row_number().over(w)).withColumn(
        "battingOrder", (F.col("slot") * 100 + F.when(F.col("l_quantity") > 40, 1).otherwise(0)).cast("string"))
    b = F.struct(F.col("l_partkey").alias("personId"), "battingOrder", F.col("p_name").alias("name"))
    per = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.when(F.col("l_returnflag") == "R", F.struct("slot", b)))).alias("h"),
        F.sort_array(F.collect_list(F.when(F.col("l_returnflag") == "A", F.struct("slot", b)))).alias("a"))
    nation = F.broadcast(load(spark, d, "nation").select("n_nationkey", "n_name"))   # team dim: bounded
    g = S.games_df(spark, d).select("game_pk", "home_team", "away_team")
    g = (g.join(nation.select(F.col("n_nationkey").alias("home_team"), F.col("n_name").alias("home_name")), "home_team", "left")
          .join(nation.select(F.col("n_nationkey").alias("away_team"), F.col("n_name").alias("away_name")), "away_team", "left"))
    j = per.join(g, per.l_orderkey == g.game_pk)
    doc = F.struct(
        F.struct(F.struct(F.upper(F.substring("home_name", 1, 3)).alias("abbreviation")).alias("home"),
                 F.struct(F.upper(F.substring("away_name", 1, 3)).alias("abbreviation")).alias("away")).alias("teamInfo"),
        F.transform("h", lambda x: x.getField("col2")).alias("homeBatters"),
        F.transform("a", lambda x: x.getField("col2")).alias("awayBatters"))
    return j.select("game_pk", F.to_json(doc).alias("box"))


@register("boxscore_lineups", f"""
WITH {S.GAMES_SQL.strip()},
li AS (
  SELECT l.l_orderkey, l.l_returnflag, l.l_partkey, p.p_name, l.l_quantity,
         ROW_NUMBER() OVER (PARTITION BY l.l_orderkey, l.l_returnflag ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                            l.l_quantity, l.l_extendedprice, l.l_shipdate) AS slot
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_returnflag IN ('R', 'A'))
SELECT g.game_pk, CASE WHEN li.l_returnflag = 'R' THEN 'home' ELSE 'away' END AS side,
       CASE WHEN li.l_returnflag = 'R' THEN upper(substr(hn.n_name, 1, 3)) ELSE upper(substr(an.n_name, 1, 3)) END AS team,
       li.l_partkey AS person_id, li.p_name AS name, CAST(li.slot AS VARCHAR) AS slot
FROM li JOIN games g ON g.game_pk = li.l_orderkey
LEFT JOIN nation hn ON hn.n_nationkey = g.home_team LEFT JOIN nation an ON an.n_nationkey = g.away_team
WHERE li.l_quantity <= 40""")
def boxscore_lineups(spark, d):
    """Starting lineups (slot, side, team) from box-score JSON."""
    return N.boxscore_lineups(box_scores(spark, d), "box", BOX, keep=["game_pk"])


ROW_PATTERN = r"<li>(.*?)</li>"
CELL_PATTERN = r'(?:href="|>)([^"<>]+)'


@register("html_rows", r"""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS row_html,
                  generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) - 1 AS row_idx FROM pages)
SELECT page_id, CAST(row_idx AS INTEGER) AS row_idx, row_html FROM r WHERE row_idx > 0""")
def html_rows(spark, d):
    """List rows of every page (header row skipped)."""
    return N.html_rows(load(spark, d, "pages"), "html", ROW_PATTERN, keep=["page_id"])


@register("html_cells_typed", r"""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS row_html,
                  generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) - 1 AS row_idx FROM pages),
c AS (SELECT page_id, row_idx, list_transform(regexp_extract_all(row_html, '(?:href="|>)([^"<>]+)', 1), lambda x: trim(x)) AS cells
      FROM r WHERE row_idx > 0)
SELECT page_id, CAST(row_idx AS INTEGER) AS row_idx, cells[1] AS link, cells[2] AS label,
       TRY_CAST(cells[2] AS DOUBLE) AS label_number
FROM c WHERE cells[1] LIKE '/%'""")
def html_cells_typed(spark, d):
    """Positional cells -> named typed columns; keep rows whose first cell is a link."""
    rows = N.html_rows(load(spark, d, "pages"), "html", ROW_PATTERN, keep=["page_id"])
    cells = rows.select("page_id", "row_idx", N.html_cells(F.col("row_html"), CELL_PATTERN).alias("cells"))
    typed = N.cells_typed(cells, "cells", {"link": (0, "string"), "label": (1, "string"), "label_number": (1, "double")})
    return typed.filter(F.col("link").startswith("/"))


TABLE_ROW, TABLE_CELL = r"<tr>(.*?)</tr>", r"<td>([^<]*)</td>"


def game_tables(spark, d):
    """One HTML table per game: a header, then a row of team code, player, quantity, percentage and
    price in cents for each of its lines with return flag R (home) or A (away), in line order. A
    table is bounded by its game's number of lines."""
    nation = F.broadcast(load(spark, d, "nation").select("n_nationkey", F.upper(F.substring("n_name", 1, 3)).alias("code")))   # team dim: bounded
    games = S.games_df(spark, d).select("game_pk", "home_team", "away_team")
    games = games.join(nation.withColumnsRenamed({"n_nationkey": "home_team", "code": "home"}), "home_team", "left")
    games = games.join(nation.withColumnsRenamed({"n_nationkey": "away_team", "code": "away"}), "away_team", "left")
    li = load(spark, d, "lineitem").filter(F.col("l_returnflag").isin("R", "A"))
    li = li.join(games, li.l_orderkey == games.game_pk)
    cells = [F.coalesce(F.when(F.col("l_returnflag") == "R", F.col("home")).otherwise(F.col("away")), F.lit("")), F.col("l_partkey").cast("string"),
             F.col("l_quantity").cast("long").cast("string"), F.concat(F.floor(F.col("l_discount") * 100 + 0.5).cast("string"), F.lit("%")),
             F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("string")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td> "), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    per = li.select("game_pk", "home", F.struct(*S.LINE_ORDER, row.alias("row")).alias("line")).groupBy("game_pk", "home").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    body = F.array_join(F.transform("lines", lambda x: x["row"]), "")
    return per.select("game_pk", "home", F.concat(F.lit("<table><tr><th>Team</th></tr>"), body, F.lit("</table>")).alias("html"))


@register("html_team_cells", f"""
WITH {S.GAMES_SQL.strip()}, named AS (
  SELECT g.game_pk, upper(substr(h.n_name, 1, 3)) AS home, upper(substr(a.n_name, 1, 3)) AS away
  FROM games g LEFT JOIN nation h ON h.n_nationkey = g.home_team LEFT JOIN nation a ON a.n_nationkey = g.away_team),
r AS (SELECT game_pk, home, CASE WHEN l_returnflag = 'R' THEN home ELSE COALESCE(away, '') END AS team, l_partkey, l_quantity, l_discount, l_extendedprice,
             ROW_NUMBER() OVER (PARTITION BY game_pk ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS row_idx
      FROM lineitem JOIN named ON game_pk = l_orderkey WHERE l_returnflag IN ('R', 'A'))
SELECT game_pk, CAST(row_idx AS INTEGER) AS row_idx, team, l_partkey AS person_id, FLOOR(l_quantity) AS quantity,
       FLOOR(l_discount * 100 + 0.5) / 100 AS share, CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents
FROM r WHERE team = home""")
def html_team_cells(spark, d):
    """The rows of a team found by its cell, with numeric and percentage cells as typed columns."""
    from diamondlake.functions.scalars import percent_to_fraction
    rows = N.html_rows(game_tables(spark, d), "html", TABLE_ROW, keep=["game_pk", "home"])
    cells = rows.select("game_pk", "home", "row_idx", N.html_cells(F.col("row_html"), TABLE_CELL).alias("cells"))
    typed = N.cells_typed(cells, "cells", {"team": (0, "string"), "person_id": (1, "long"), "quantity": (2, "double"), "percent": (3, "string"), "cents": (4, "long")})
    return typed.where("team = home").select("game_pk", "row_idx", "team", "person_id", "quantity", percent_to_fraction("percent").alias("share"), "cents")
