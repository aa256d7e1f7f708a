"""The 36-feature team-game table, the forecast and the matchup models."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from diamondlake.operators import forecast as FC
from diamondlake.operators import models as M
from diamondlake.operators import stats as ST
from diamondlake.operators import team_features as TF
from diamondlake.plans import models as PM
from diamondlake.sources.files import shared_path

DAY = datetime.date(2024, 4, 1)
COUNTERS = TF.HIT_COUNTERS + TF.PITCH_COUNTERS


def day(n):
    return DAY + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def season(spark):
    """Three teams over twenty days; team 1 plays twice on day 3; team 9's opponent is unknown."""
    rng = random.Random(1)
    games, plays = [], []
    for n in range(20):
        pairs = [(1, 2), (2, 3), (1, 3)][n % 3:n % 3 + 1] + ([(1, 3)] if n == 3 else [])
        for k, (home, away) in enumerate(pairs):
            pk = n * 10 + k
            games += [(pk, day(n), 2024, home, away, True, rng.randrange(9), 3), (pk, day(n), 2024, away, home, False, 3, 4)]
            for _ in range(12):
                off, dfn = rng.choice([(home, away), (away, home)])
                h, bb = rng.random() < .3, rng.random() < .1
                row = dict.fromkeys(COUNTERS, 0) | {"pa": 1, "ab": int(not bb), "h": int(h and not bb), "bb": int(bb), "p_bb": int(bb), "outs": int(not h and not bb), "rbi": int(h), "er": int(h)}
                plays.append((day(n), 2024, off, dfn, off * 100 + rng.randrange(8), dfn * 100 + rng.randrange(3), *row.values()))
    games.append((999, day(5), 2024, 9, None, True, 1, 0))
    g = spark.createDataFrame(games, "game_pk long, day date, season int, offense_team long, defense_team long, is_home boolean, runs_scored int, runs_allowed int")
    p = spark.createDataFrame(plays, "day date, season int, offense_team long, defense_team long, batter long, pitcher long, " + ", ".join(f"{c} long" for c in COUNTERS))
    return g, p, games, plays


def test_table_matches_plain_python(season):
    g, p, games, plays = season
    got = {(r["game_pk"], r["is_home"]): r for r in TF.team_game_table(g, p).collect()}
    assert len(got) == len(games)
    at = {c: 6 + k for k, c in enumerate(COUNTERS)}

    def rate(rows, a, b):
        n, d = sum(x[at[a]] for x in rows), sum(x[at[b]] for x in rows)
        return None if not d else n / d
    for pk, on, _, off, dfn, home, *_ in games:
        row = got[pk, home]
        mine = [x for x in plays if x[2] == off and x[0] < on]
        week = [x for x in mine if x[0] >= on - datetime.timedelta(days=7)]
        assert row["total_games"] == sum(x[3] == off and x[1] < on for x in games)
        for name, rows in (("avg", mine), ("avg_week", week)):
            want = rate(rows, "h", "ab")
            assert (row[name] is None) if want is None else abs(row[name] - want) < 1e-4
        batters = sorted({x[4] for x in week}, key=lambda b: (-sum(x[4] == b for x in week), b))[:5]
        means = [m for m in (rate([x for x in week if x[4] == b], "h", "ab") for b in batters) if m is not None]
        assert (row["avg_5"] is None) if not means else abs(row["avg_5"] - sum(means) / len(means)) < 1e-4
        against = [x for x in plays if x[3] == dfn and x[0] < on]
        era = rate(against, "er", "outs")
        assert (row["era"] is None) if era is None or dfn is None else abs(row["era"] - 27 * era) < 1e-3


def test_table_of_no_games_and_no_plays(season):
    g, p, games, _ = season
    assert TF.team_game_table(g.limit(0), p).count() == 0
    alone = TF.team_game_table(g, p.limit(0))
    assert alone.count() == len(games) and alone.where("avg IS NOT NULL OR era IS NOT NULL").count() == 0


def test_forecast_stops_each_row_at_its_own_day(spark):
    states = spark.createDataFrame([(t, day(n), float(n % 4 + t), float(10 * t - n % 3) if n % 5 else None) for t in (1, 2) for n in range(40)], "team long, day date, a double, b double")
    history = FC.ema_by_day(states, "team", "day", ["a", "b"])
    assert history.where("target = 1.0").count() == 64          # days without a value drop out
    unit = FC.scales(history)
    model = FC.fit(history, unit, num_trees=5, statistics=2)
    last = FC.latest(history, "team", "day").drop("day")
    games = last.crossJoin(spark.createDataFrame([(0,), (1,), (9,)], "ahead int"))
    path = shared_path(spark, "test-forecast")
    moved = {(r["team"], r["target"], r["ahead"]): r["value"] for r in FC.roll_forward(model, unit, games, path).collect()}
    here = {(r["team"], r["target"]): r["value"] for r in last.collect()}
    assert len(moved) == 12 and all(moved[t, k, 0] == v for (t, k), v in here.items())
    # a day ahead is what MLlib's own transform says
    one = model.transform(FC._scaled(last, unit)).select("team", "target", (F.col("next") * F.col("sd") + F.col("mean")).alias("value")).collect()
    assert all(abs(moved[r["team"], r["target"], 1] - r["value"]) < 1e-9 for r in one) and len(one) == 4
    wide = FC.wide_form(FC.roll_forward(model, unit, games, path), ["team", "ahead"], ["a", "b"])
    assert wide.columns == ["team", "ahead", "a", "b"] and wide.count() == 6


def test_opponent_changes_the_score(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(80):
        x = {c: rng.random() for c in TF.FEATURES}
        rows.append((*x.values(), int(x["avg"] - x["era"] > 0), 5 + x["avg"] * 3 - x["era"] * 2))
    table = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in TF.FEATURES) + ", win int, runs_scored double")
    model = M.fit_game_models(table, TF.FEATURES, "win", "runs_scored")
    games = spark.createDataFrame([(1, 10, 20), (2, 10, 30)], "game_pk long, home_team long, away_team long")
    team = {10: .5, 20: .1, 30: .9}
    forecast = spark.createDataFrame([(g, t, *([team[t]] * 36)) for g, pair in ((1, (10, 20)), (2, (10, 30))) for t in pair], "game_pk long, team long, " + ", ".join(f"{c} double" for c in TF.FEATURES))
    got = {r["game_pk"]: r for r in PM.matchup_scores(model, games, forecast).collect()}
    assert len(got) == 2 and got[1]["home_score"] != got[2]["home_score"] and got[1]["home_runs"] != got[2]["home_runs"]


def test_correlation_matrix_is_one_pass_and_whole(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.0, 5.0), (None, 1.0, 5.0)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in ST.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "b"] == got["b", "a"] == 0.9333 and got["a", "a"] == 1.0 and got["a", "c"] is None
    assert {r["corr"] for r in ST.corr_matrix(df.limit(0), ["a", "b"]).collect()} == {None}


def test_ordered_operators_have_no_python_node(spark):
    from diamondlake.plans.catalog import queries
    from tests.conftest import SF_SMALL
    for key in ("win_lag", "streak_hits_only", "win_season_to_date", "win_rolling_10", "split_chronological", "transition_probs"):
        plan = queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Pandas" not in plan and "Python" not in plan, key
