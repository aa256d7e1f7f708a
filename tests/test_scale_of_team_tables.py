"""Work and memory of the team tables, forecasts and scans grow no faster than their rows; results stay those of plain Python."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from diamondlake.operators import forecast as FC
from diamondlake.operators import scan as SC
from diamondlake.operators import stats as ST
from diamondlake.operators import team_features as TF
from diamondlake.operators import walk_forward as WF
from diamondlake.operators import windows as WN
from diamondlake.plans import models as PM

D = dt.date(2024, 4, 1)


def at(n):
    return D + dt.timedelta(days=n)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_most_active_players_of_each_week(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), rng.choice([*range(12), None]), at(rng.randrange(30)) if rng.random() < .97 else None, rng.choice([0, 0, 1, 2, None]), 1) for _ in range(700)]
    rows += [(3, 7, at(2), 1, 1), (3, 7, at(9), 1, 1), (3, 8, at(2), 1, 1)]       # a day that leaves as another enters
    play = spark.createDataFrame(rows, "team int, player long, day date, a long, one long")
    days = [(t, at(n)) for t in (1, 2, 3) for n in range(45) if n % 3]
    got = {}
    chosen = TF.most_active(play, spark.createDataFrame([*days, *days], "team int, day date"), "a")
    for r in chosen.collect():
        got.setdefault((r["team"], r["day"]), []).append(r["player"])
    sums = {(r["team"], r["day"], r["player"]): (r["a"], r["one"]) for r in TF._players_week(play, chosen, ["a", "one"]).collect()}
    n = 0
    for team, day in days:
        week = {}
        for t, p, d, a, _ in rows:
            if t == team and d and 1 <= (day - d).days <= 7:
                week.setdefault(p, []).append(a)
        total = {p: None if all(x is None for x in v) else sum(x or 0 for x in v) for p, v in week.items()}
        best = sorted(total, key=lambda p: (total[p] is None, -(total[p] or 0), p is not None, p or 0))[:5]
        assert set(got.get((team, day), [])) == set(best) and len(got.get((team, day), [])) == len(best)
        for p in best:
            assert sums[team, day, p] == (total[p], len(week[p]))
            n += 1
    assert len(sums) == n


def test_games_keep_their_place_when_features_are_joined(spark):
    counters = TF.HIT_COUNTERS + TF.PITCH_COUNTERS
    games = spark.createDataFrame([(1, D, 2024, 1, 2, True, 3, 1), (1, D, 2024, 2, 1, False, 1, 3)], "game_pk long, day date, season int, offense_team long, defense_team long, is_home boolean, runs_scored int, runs_allowed int")
    plays = spark.createDataFrame([(D, 2024, 1, 2, 5, 6, *([1] * len(counters)))], "day date, season int, offense_team long, defense_team long, batter long, pitcher long, " + ", ".join(f"{c} long" for c in counters))
    table = TF.team_game_table(games, plays)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(table.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    left = plan[:plan.index("BroadcastExchange")]
    assert "hashpartitioning(offense_team" not in left and "SortMergeJoin LeftOuter" not in plan
    assert table.count() == 2


def test_a_forecast_is_made_once_per_team_and_day(spark, monkeypatch):
    monkeypatch.setattr(PM, "TREES", 2)
    rng = random.Random(2)
    days = spark.createDataFrame([(t, at(n), *[rng.random() for _ in TF.FEATURES]) for t in (1, 2) for n in range(12)], "team long, day date, " + ", ".join(f"{c} double" for c in TF.FEATURES))
    games = spark.createDataFrame([(pk, at(14 + pk % 2), 1, 2) for pk in range(40)], "game_pk long, day date, home_team long, away_team long")
    rolled, real = [], FC.roll_forward
    monkeypatch.setattr(FC, "roll_forward", lambda model, unit, state, path: rolled.append(state.count()) or real(model, unit, state, path))
    got = PM._forecast(games, days).collect()
    assert rolled == [2 * 2 * len(TF.FEATURES)]
    assert len(got) == 80 and {(r["game_pk"], r["team"]) for r in got} == {(pk, t) for pk in range(40) for t in (1, 2)}
    assert all(r["ahead"] == 3 + r["game_pk"] % 2 for r in got)
    assert len({(r["team"], r["ahead"], r["avg"]) for r in got}) == 4


def test_correlation_and_backtest_deal_out_and_write_no_wide_rows(spark):
    df = spark.range(4000).select(*[(F.col("id") * (k + 3) % 97).cast("double").alias(f"c{k}") for k in range(6)], F.date_add(F.lit(D), (F.col("id") % 9).cast("int")).alias("day"))
    folder = spark.conf.get("spark.checkpoint.dir")

    def size():
        return sum(os.path.getsize(os.path.join(a, f)) for a, _, names in os.walk(folder) for f in names)
    held = size()
    assert ST.corr_matrix(df, [f"c{k}" for k in range(6)]).count() == 36
    assert size() == held
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(WF.walk_forward(df, "day", ["c0", "c1"], F.col("c2")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [day" not in plan.split("BroadcastExchange")[0] and "BroadcastHashJoin [day" in plan


def test_rows_are_not_dealt_out_by_few_keys(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 5 > 0, F.lit("a")).otherwise(F.when(F.col("id") % 2 == 0, F.lit("b"))).alias("k"), F.col("id").alias("v"), F.col("id").cast("string").alias("s"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        out = WN.partition_avg_max(df, "k", "v", "m", "x")
        assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
        assert out.where("x IS NULL").count() == 0 and out.count() == 60_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("rows", [1, 7, 500])
def test_a_scan_holds_a_chunk_at_a_time(spark, rows):
    rng = random.Random(9)
    data = [(rng.choice("aaaab") if i % 40 else None, i, None if rng.random() < .3 else rng.gauss(3, 2)) for i in range(400)]
    df = spark.createDataFrame(data, "t string, i long, x double")
    got = {r["i"]: r["x_ema"] for r in SC.ema_scan(df, "t", ["i"], ["x"], digits=None, num_partitions=3, chunk_rows=rows).collect()}
    for t in ("a", "b", None):
        mine = [r for r in data if r[0] == t]
        want = pd.Series([r[2] for r in mine], dtype=float).ewm(span=28, adjust=False).mean()
        for r, w in zip(mine, want, strict=True):
            assert (got[r[1]] is None) if w != w else abs(got[r[1]] - w) < 1e-9
    parts = [len(p) for p in SC._chunks(iter([pd.DataFrame({"x": range(n)}) for n in (3, 0, 4, 1, 2)]), 5)]
    assert parts == [7, 3]
