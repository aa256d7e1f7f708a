"""Team-game feature table (Q10): 23 hitting features of the team at bat and 13
pitching features of its opponent, all from days before the game.

Plate appearances are first summed to integer counters per (team, day) and per
day of the league, so everything after that works on day rows: a (team, season)
has one row per playing day, and a running window over it is bounded by the
calendar however many appearances a day holds. The trailing week of a team is a
partial sum: every day row is counted into the days after it, so neither an
unpartitioned window nor a range join is needed.

Players aren't spread over the days of their weeks. A player's activity of the
trailing week only changes when a day enters or leaves it, so a window over each
player's days gives spans of days with one value. Of spans with the same first
and last day only the best five can be among a day's five; that leaves a number
of spans that the calendar bounds. Counters are summed for the chosen players alone.

Rates are SQL text over counter names (see ``HITTING`` and ``PITCHING``); the
league's counters have the prefix ``lg_``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up
from diamondlake.session import cut_lineage, store

HIT_COUNTERS = ["pa", "ab", "h", "d2", "d3", "hr", "bb", "so", "sf", "sb", "rbi"]
PITCH_COUNTERS = ["outs", "p_so", "p_bb", "p_hr", "er"]

# Linear weights of a plate appearance, the scale of the weighted rate, runs per win.
WOBA = "(0.69e0 * {p}bb + 0.89e0 * ({p}h - {p}d2 - {p}d3 - {p}hr) + 1.26e0 * {p}d2 + 1.6e0 * {p}d3 + 2.07e0 * {p}hr) / NULLIF({p}ab + {p}bb + {p}sf, 0)"
RUNS_ABOVE = f"(({WOBA.format(p='')}) - ({WOBA.format(p='lg_')})) / 1.25e0"
LEAGUE_RUNS = "CAST(lg_rbi AS DOUBLE) / NULLIF(lg_pa, 0)"
ERA = "27e0 * {p}er / NULLIF({p}outs, 0)"

HITTING = {
    "rbis": "CAST(rbi AS DOUBLE)",
    "avg": "CAST(h AS DOUBLE) / NULLIF(ab, 0)",
    "obp": "CAST(h + bb AS DOUBLE) / NULLIF(ab + bb + sf, 0)",
    "slg": "CAST(h + d2 + 2 * d3 + 3 * hr AS DOUBLE) / NULLIF(ab, 0)",
    "wrc_plus": f"100e0 * ({RUNS_ABOVE} + {LEAGUE_RUNS}) / NULLIF({LEAGUE_RUNS}, 0e0)",
    "war": f"({RUNS_ABOVE} * pa + 0.2e0 * sb) / 10e0",
    "k_pct": "CAST(so AS DOUBLE) / NULLIF(pa, 0)",
    "bb_pct": "CAST(bb AS DOUBLE) / NULLIF(pa, 0)",
    "bsr": "0.2e0 * sb",
}
PITCHING = {
    "opp_k9": "27e0 * p_so / NULLIF(outs, 0)",
    "opp_hr9": "27e0 * p_hr / NULLIF(outs, 0)",
    "opp_bb9": "27e0 * p_bb / NULLIF(outs, 0)",
    "era": ERA.format(p=""),
    "opp_war": f"(({ERA.format(p='lg_')}) - ({ERA.format(p='')})) * outs / 270e0",
}
#: Rates of the trailing week, for the team and for the mean of its five most active players.
HIT_WEEK = ["avg", "obp", "slg", "war", "wrc_plus", "k_pct", "bb_pct"]
PITCH_WEEK = ["opp_k9", "opp_bb9", "era", "opp_war"]

HIT_FEATURES = [*HITTING, *[f"{c}_5" for c in HIT_WEEK], *[f"{c}_week" for c in HIT_WEEK]]
PITCH_FEATURES = [*PITCHING, *[f"{c}_5" for c in PITCH_WEEK], *[f"{c}_week" for c in PITCH_WEEK]]
FEATURES = HIT_FEATURES + PITCH_FEATURES

DAYS, PLAYERS, DIGITS = 7, 5, 4
#: Rates of players are averaged as whole millionths, so the sum has no order.
MICRO = 1_000_000


def _sums(cols: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in cols]


def _after(days: DataFrame, keys: list[str], cols: list[str], n: int = DAYS) -> DataFrame:
    """Sums of ``cols`` over the ``n`` days before each day, by ``keys``."""
    moved = days.select(*keys, F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", n))).alias("day"), *cols)
    return moved.groupBy(*keys, "day").agg(*_sums(cols))


def _rates(df: DataFrame, rates: dict[str, str], names: list[str], suffix: str = "") -> list[Column]:
    return [round_half_up(F.expr(rates[c]), DIGITS).alias(c + suffix) for c in names]


def _best(df: DataFrame, keys: list[str]) -> DataFrame:
    """The ``PLAYERS`` rows of each of ``keys`` with the most ``active``, ties by player."""
    best = Window.partitionBy(*keys).orderBy(F.desc("active"), "player")
    return df.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= PLAYERS).drop("rn")


def most_active(play: DataFrame, days: DataFrame, active: str, n: int = DAYS) -> DataFrame:
    """(team, day, player): for each (team, day) of ``days`` the ``PLAYERS`` players with the most ``active`` (a whole
    number) in the ``n`` days before, ties by player, from ``play`` (team, player, day, ``active``)."""
    daily = play.where("team IS NOT NULL AND day IS NOT NULL").groupBy("team", "player", "day").agg(F.sum(active).alias("active"))
    # A day counts from the next day on, for n days.
    turns = [F.struct(F.date_add("day", at).alias("start"), F.lit(sign).alias("n"), (sign * F.col("active")).alias("active"), F.when(F.col("active").isNotNull(), sign).alias("known")) for at, sign in ((1, 1), (n + 1, -1))]
    own = Window.partitionBy("team", "player").orderBy("start")
    upto = own.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spans = daily.select("team", "player", F.explode(F.array(*turns)).alias("t")).select("team", "player", "t.*")
    spans = spans.select("team", "player", "start", F.lead("start").over(own).alias("until"), F.sum("n").over(upto).alias("n"), F.sum("active").over(upto).alias("active"), F.sum("known").over(upto).alias("known"))
    spans = spans.where("n > 0 AND until > start").select("team", "player", "start", "until", F.when(F.col("known") > 0, F.col("active")).alias("active"))
    spans = _best(spans, ["team", "start", "until"])
    each = spans.select("team", "player", "active", F.explode(F.sequence("start", F.date_sub("until", 1))).alias("day"))
    return _best(each.join(days.distinct(), ["team", "day"]), ["team", "day"]).select("team", "day", "player")


def _players_week(play: DataFrame, chosen: DataFrame, cols: list[str], n: int = DAYS) -> DataFrame:
    """Sums of ``cols`` over the ``n`` days before the day of each row of ``chosen`` (team, day, player)."""
    def block(day: Column) -> Column:
        return F.floor(F.unix_date(day) / n)
    blocks = F.array_distinct(F.array(block(F.date_sub("day", n)), block(F.date_sub("day", 1))))
    wanted = chosen.select(F.col("team").alias("__team"), F.col("player").alias("__player"), F.col("day").alias("__day"), F.explode(blocks).alias("__block"))
    same = (F.col("team") == F.col("__team")) & F.col("player").eqNullSafe(F.col("__player")) & (block(F.col("day")) == F.col("__block"))
    within = F.datediff("__day", "day").between(1, n)
    near = play.join(F.broadcast(wanted), same & within)      # twice PLAYERS rows per team and day
    return near.groupBy("team", F.col("__day").alias("day"), "player").agg(*_sums(cols))


def _mean(players: DataFrame, rates: dict[str, str], names: list[str]) -> DataFrame:
    """Mean rates of the rows of each (team, day)."""
    micro = [F.floor(F.expr(rates[c]) * MICRO + F.lit(0.5)).cast("long").alias(c) for c in names]
    mean = [round_half_up(F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)) / float(MICRO), DIGITS).alias(f"{c}_5") for c in names]
    return players.select("team", "day", *micro).groupBy("team", "day").agg(*mean)


def _side(appearances: DataFrame, team: str, player: str, cols: list[str], rates: dict[str, str], week: list[str], spine: DataFrame, active: str) -> DataFrame:
    """Per (team, day) of ``spine``: rates of the season to date, of the week, and of the week's most active players."""
    play = appearances.select(F.col(team).alias("team"), F.col(player).alias("player"), "season", "day", *cols)
    team_day = play.groupBy("team", "season", "day").agg(*_sums(cols))
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cols]
    team_day = cut_lineage(spine.select("team", "season", "day").join(team_day, ["team", "season", "day"], "left").select("team", "season", "day", *zero))
    league = team_day.groupBy("season", "day").agg(*_sums(cols))
    so_far = Window.partitionBy("season").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("team", "season").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    lg = league.select("season", "day", *[F.sum(c).over(so_far).alias(f"lg_{c}") for c in cols])
    to_date = team_day.select("team", "season", "day", *[F.sum(c).over(own).alias(c) for c in cols]).join(lg, ["season", "day"])
    out = to_date.select("team", "season", "day", *_rates(to_date, rates, list(rates)))
    lg_week = _after(league, [], cols).select("day", *[F.col(c).alias(f"lg_{c}") for c in cols])
    in_week = _after(team_day, ["team"], cols).join(lg_week, "day")
    weekly = in_week.select("team", "day", *_rates(in_week, rates, week, "_week"))
    chosen = cut_lineage(most_active(play, spine.select("team", "day"), active))
    five = _mean(_players_week(play, chosen, cols).join(lg_week, "day"), rates, week)
    return store(out.join(weekly, ["team", "day"], "left").join(five, ["team", "day"], "left"))


def _spine(games: DataFrame) -> DataFrame:
    """Each team's playing days, with its games and runs of the season before the day."""
    mine = games.select(F.col("offense_team").alias("team"), "season", "day", "runs_scored")
    per_day = mine.where("team IS NOT NULL").groupBy("team", "season", "day").agg(F.count("*").alias("games"), F.sum("runs_scored").alias("runs"))
    own = Window.partitionBy("team", "season").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(per_day.select("team", "season", "day", F.coalesce(F.sum("games").over(own), F.lit(0)).alias("total_games"),
                                      F.coalesce(F.sum("runs").over(own), F.lit(0)).cast("long").alias("total_runs")))


def _hitting(spine: DataFrame, appearances: DataFrame) -> DataFrame:
    return _side(appearances, "offense_team", "batter", HIT_COUNTERS, HITTING, HIT_WEEK, spine, "pa")


def _pitching(spine: DataFrame, appearances: DataFrame) -> DataFrame:
    return _side(appearances, "defense_team", "pitcher", PITCH_COUNTERS, PITCHING, PITCH_WEEK, spine, "outs")


def team_days(games: DataFrame, appearances: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each team's playing days, and the hitting and the pitching statistics before each; one row per team and day."""
    spine = _spine(games)
    return spine, _hitting(spine, appearances), _pitching(spine, appearances)


def team_day_table(games: DataFrame, appearances: DataFrame, known: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """Each team's own 23 hitting and 13 pitching statistics before each of its playing
    days: team, season, day and ``FEATURES``. Inputs as in ``team_game_table``."""
    _, hitting, pitching = known or team_days(games, appearances)
    return hitting.join(pitching, ["team", "season", "day"]).select("team", "season", "day", *FEATURES)


def team_game_table(games: DataFrame, appearances: DataFrame, known: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per row of ``games`` (game_pk, day, season, offense_team,
    defense_team, is_home, runs_scored, runs_allowed): total_games and total_runs of
    the season before the day, the 23 hitting features of the offense, the 13
    pitching features of the defense, runs_scored and win.

    ``appearances`` has a row per plate appearance: day, season, offense_team,
    defense_team, batter, pitcher and the counters. Days before a team's first of
    a season, and weeks without an appearance, give NULL; a game of an unknown
    team keeps its row, with NULL features. ``known`` has the ``team_days`` of both inputs, if they are at hand."""
    spine, hitting, pitching = known or team_days(games, appearances)
    hit = spine.join(hitting, ["team", "season", "day"])
    hit = hit.select(F.col("team").alias("offense_team"), "day", "total_games", "total_runs", *HIT_FEATURES)
    pitch = pitching.select(F.col("team").alias("defense_team"), "day", *PITCH_FEATURES)
    # One row per team and day on the right, so the games stay where they are.
    out = games.join(F.broadcast(hit), ["offense_team", "day"], "left").join(F.broadcast(pitch), ["defense_team", "day"], "left")
    return out.select("game_pk", "day", "season", "offense_team", "defense_team", "is_home", "total_games", "total_runs", *FEATURES,
                      F.col("runs_scored").cast("long").alias("runs_scored"), (F.col("runs_scored") > F.col("runs_allowed")).cast("int").alias("win"))
