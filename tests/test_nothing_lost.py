"""NULL keys and missing values lose no rows; inserted rows and last duplicates are whole."""

from pyspark.sql import functions as F

from diamondlake.functions import scalars as FN
from diamondlake.operators import aggregates as A, keys as K, ordering as O, upsert as U, windows as WN


def got(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_null_group_keeps_its_values(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 4.0), ("a", 1.0)], "k string, v double")
    assert got(WN.partition_avg_max(df, "k", "v", "m", "x"), "k", "v", "m", "x") == [("a", 1.0, 1.0, 1.0), (None, 2.0, 3.0, 4.0), (None, 4.0, 3.0, 4.0)]


def test_null_entities_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "e string, i long")
    for safe in (False, True):
        assert O.split_chronological(df, "e", ["i"], skew_safe=safe).count() == 3
    plays = spark.createDataFrame([(None, "0", "x", "1", 1), ("a", "0", "x", None, 0)], "e string, s string, v string, nx string, r int")
    assert got(A.transition_probs(plays, "e", "s", "v", "nx", "r"), "e", "prob") == [("a", 1.0), (None, 1.0)]


def test_null_entity_in_trailing_and_rolling_sums(spark):
    df = spark.createDataFrame([(None, "2024-01-01", 1, 1), (None, "2024-01-02", 3, 1), ("a", "2024-01-01", 5, 1)], "e string, d string, n int, one int")
    df = df.withColumn("d", F.col("d").cast("date"))
    assert got(WN.trailing_days_ratio(df, "e", "d", "n", "one", "x"), "e", "n", "x") == [("a", 5, 5.0), (None, 1, 1.0), (None, 3, 2.0)]
    for safe in (False, True):
        assert got(WN.rolling_sum(df, "e", "d", "n", "x", 1, skew_safe=safe).select("e", "n", F.col("x").cast("int"))) == [("a", 5, 5), (None, 1, 1), (None, 3, 3)]


def test_null_key_parts_stay_apart(spark):
    df = spark.createDataFrame([("1", None, "2"), ("1", "2", None)], "a string, b string, c string")
    assert df.select(K.key_concat(["a", "b", "c"])).distinct().count() == 2
    assert K.key_collision_audit(df, ["a", "b", "c"], "-").first()["collisions"] == 0


def test_upsert_inserts_whole_rows(spark):
    t = spark.createDataFrame([(1, "A", 1, "X")], "k long, n string, v int, seg string")
    s = spark.createDataFrame([(1, "B", 2, "Y"), (2, "B", 20, "Z")], "k long, n string, v int, seg string")
    assert got(U.upsert_by_key(t, s, ["k"], ["n", "v"]), "k", "n", "v", "seg") == [(1, "B", 2, "X"), (2, "B", 20, "Z")]


def test_accents_and_links(spark):
    df = spark.createDataFrame([("Straße Øre æ é", '<article><a href="/x">Home\n</a> <b>c</b>')], "t string, h string")
    assert tuple(df.select(FN.strip_accents("t"), FN.link_text("h")).first()) == ("Strasse Ore ae e", "Home\n")


def test_forecast_has_both_teams_of_every_game(spark):
    from diamondlake.plans import models as PM
    from diamondlake.plans import team_table as TT
    from tests.conftest import SF_SMALL
    games, _, days = PM._upcoming(spark, SF_SMALL)
    unknown = spark.createDataFrame([(-1, 98, 99)], "game_pk long, home_team long, away_team long")      # teams without any history
    day = games.agg(F.max("day").alias("day"))
    games = games.unionByName(unknown.join(day).select(*games.columns))
    got = PM._forecast(games, days).collect()
    want = {(g["game_pk"], t) for g in games.collect() for t in (g["home_team"], g["away_team"])}
    assert {(r["game_pk"], r["team"]) for r in got} == want
    assert all(r[c] is not None for r in got for c in TT.TF.FEATURES)


def test_every_scheduled_game_is_predicted(spark):
    from diamondlake.plans import standins as S
    from diamondlake.plans.models import UPCOMING_DAYS, predict_games
    from tests.conftest import SF_SMALL
    games = S.games_df(spark, SF_SMALL).where("home_team IS NOT NULL AND away_team IS NOT NULL")
    last = S.games_df(spark, SF_SMALL).agg(F.date_sub(F.max("game_date"), UPCOMING_DAYS)).first()[0]
    want = {r["game_pk"] for r in games.where(F.col("game_date") >= F.lit(last)).collect()}
    out = predict_games(spark, SF_SMALL).collect()
    assert want == {r["game_pk"] for r in out} and len(out) == len(want)
    assert all(r["team_winner"] in (r["home_team"], r["away_team"], None) for r in out)
