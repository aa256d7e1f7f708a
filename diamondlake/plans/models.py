"""Model pipeline queries (M1-M8, Q8) on the team-game feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.functions import scalars as FN
from diamondlake.functions.scalars import round_half_up, round_half_up_sql as R
from diamondlake.operators import forecast as FC
from diamondlake.operators import models as M
from diamondlake.operators import team_features as TF
from diamondlake.operators import walk_forward as WF
from diamondlake.operators import windows as WN
from diamondlake.operators.ordering import split_hash
from diamondlake.plans.catalog import register
from diamondlake.plans import team_table as TT
from diamondlake.plans.joins_aggs import CUSTOMER_STATS_SQL, customer_stats
from diamondlake.session import cut_lineage, store
from diamondlake.sources.files import shared_path
from diamondlake.sources.tables import load

FEATURES = TF.FEATURES


def _model_rows(spark, d):
    return M.assemble(TT.feature_table(spark, d), FEATURES)


PLACES = [f"x{k + 1:02d}" for k in range(len(FEATURES))]


@register("features_assemble", TT.TABLE_SQL + f"""
SELECT game_pk, is_home, offense_team, {', '.join(f'{c} AS {x}' for c, x in zip(FEATURES, PLACES, strict=True))}, win FROM ft""")
def features_assemble(spark, d):
    """M1: the 36-feature vector per team-game row, read back place by place (NULL where it lacks a value)."""
    rows = M.features_array(_model_rows(spark, d))
    at = [F.element_at("features", k + 1) for k in range(len(FEATURES))]
    return rows.select("game_pk", "is_home", "offense_team", *[F.when(~F.isnan(v), v).alias(x) for v, x in zip(at, PLACES, strict=True)], "win")


def _win_model(spark, d):
    rows = split_hash(_model_rows(spark, d), ["game_pk"])
    model = M.fit_ridge_classifier(rows.filter((F.col("split") == "train") & M.complete(FEATURES)), "win")
    return model, rows


@register("model_ridge_classify")
def model_ridge_classify(spark, d):
    """M2: ridge classifier of the win flag on the 36 features, trained on the hash-split
    train part, predictions for the test part."""
    model, rows = _win_model(spark, d)
    test = rows.filter(F.col("split") == "test")
    return M.predict_sign(model, test).select(
        "game_pk", "is_home", "win", F.when(M.complete(FEATURES), F.col("predicted")).alias("predicted"),
        F.when(M.complete(FEATURES), round_half_up("score", 6)).alias("score"))


@register("model_ridge_single", TT.TABLE_SQL + f""", f AS (
  SELECT regr_sxy(2.0 * win - 1.0, obp) / (regr_sxx(2.0 * win - 1.0, obp) + 1.0) AS w, AVG(2.0 * win - 1.0) AS y0, AVG(obp) AS x0
  FROM ft WHERE obp IS NOT NULL)
SELECT game_pk, is_home, CAST(y0 + w * (obp - x0) > 0 AS INTEGER) AS predicted, {R('y0 + w * (obp - x0)', 6)} AS score
FROM ft, f WHERE obp IS NOT NULL""")
def model_ridge_single(spark, d):
    """M2/M4 with one feature, where ridge has a closed form: fitted on all rows, which it then scores."""
    rows = M.assemble(TT.feature_table(spark, d).where("obp IS NOT NULL"), ["obp"])
    return M.predict_sign(M.fit_ridge_classifier(rows, "win"), rows).select("game_pk", "is_home", "predicted", round_half_up("score", 6).alias("score"))


@register("model_ols", CUSTOMER_STATS_SQL + f"""
SELECT {R('regr_slope(runs, n_orders)', 4)} AS slope, {R('regr_intercept(runs, n_orders)', 4)} AS intercept FROM cs""")
def model_ols(spark, d):
    """M3: OLS of runs on one predictor; value-checked against regr_slope/intercept."""
    data = M.assemble(customer_stats(spark, d), ["n_orders"])
    model = M.fit_ols(data, "runs")
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double") \
        .select(round_half_up("slope", 4).alias("slope"), round_half_up("intercept", 4).alias("intercept"))


@register("model_score")
def model_score(spark, d):
    """M4: score every team-game row (both perspectives) with the fitted model; NULL
    where a feature is missing."""
    model, rows = _win_model(spark, d)
    return model.transform(rows).select("game_pk", "is_home", "offense_team", F.when(M.complete(FEATURES), round_half_up("score", 6)).alias("score"))


UPCOMING_DAYS = 7
TREES = 100


def _upcoming(spark, d):
    """The last week's games as schedule, and the feature tables of the days before it."""
    all_games = TT.stored_games(spark, d)
    schedule = all_games.select("game_pk", F.col("game_date").alias("day"), "home_team", "away_team")
    cutoff = schedule.agg(F.date_sub(F.max("day"), UPCOMING_DAYS)).scalar()
    games = schedule.filter((F.col("day") >= cutoff) & F.col("home_team").isNotNull() & F.col("away_team").isNotNull())
    decided, seen = TT.decided_games(spark, d, all_games).filter(F.col("day") < cutoff), TT.appearances(spark, d, all_games).filter(F.col("day") < cutoff)
    known = TF.team_days(decided, seen)
    return cut_lineage(games), TF.team_game_table(decided, seen, known), TF.team_day_table(decided, seen, known)


def _forecast(games, days):
    """One row per team of each game: game_pk, team, ahead (days from its last day to the game) and the forecast
    features. A team's games of one day share a forecast, which is made once."""
    history = cut_lineage(FC.ema_by_day(days, "team", "day", FEATURES))
    unit = cut_lineage(FC.scales(history))
    model = FC.fit(history, unit, num_trees=TREES, statistics=len(FEATURES))
    playing = games.select("game_pk", "day", F.explode(F.array("home_team", "away_team")).alias("team"))
    last = FC.latest(history, "team", "day").withColumnRenamed("day", "last_day")
    state = playing.select("team", "day").distinct().join(last, "team").withColumn("ahead", F.greatest(F.datediff("day", "last_day"), F.lit(0)))
    state = cut_lineage(state.select("team", "day", "target", "value", "ema", "ahead"))
    moved = cut_lineage(FC.roll_forward(model, unit, state, shared_path(games.sparkSession, "forecast-model")))
    wide = FC.wide_form(moved, ["team", "day"], FEATURES).join(moved.groupBy("team", "day").agg(F.max("ahead").alias("ahead")), ["team", "day"])
    # A team or a statistic without history stands at the mean of all teams (one number per statistic).
    mean = {int(r["target"]): r["mean"] for r in unit.collect()}
    filled = [F.coalesce(F.col(c), F.lit(mean.get(k, 0.0))).alias(c) for k, c in enumerate(FEATURES)]
    return playing.join(F.broadcast(wide), ["team", "day"], "left").select("game_pk", "team", F.coalesce("ahead", F.lit(0)).alias("ahead"), *filled)


@register("forecast_features")
def forecast_features(spark, d):
    """M5: the 36 statistics of both teams of every upcoming game, rolled forward day by day
    from the team's last playing day to the game, EMAs frozen."""
    games, _, days = _upcoming(spark, d)
    return _forecast(games, days)


def matchup_scores(model, games, forecast):
    """Both sides of each game scored by both models: a side's hitting against the other
    side's pitching. game_pk, home_score, home_runs, away_score, away_runs."""
    def side(team, other, name):
        hit = forecast.select("game_pk", F.col("team").alias(team), *TF.HIT_FEATURES)
        pitch = forecast.select("game_pk", F.col("team").alias(other), *TF.PITCH_FEATURES)
        row = games.select("game_pk", team, other).join(hit, ["game_pk", team]).join(pitch, ["game_pk", other])
        return model.transform(row).select("game_pk", F.col("score").alias(f"{name}_score"), F.col("runs_score").alias(f"{name}_runs"))
    return side("home_team", "away_team", "home").join(side("away_team", "home_team", "away"), "game_pk")


@register("predict_games")
def predict_games(spark, d):
    """M6: predict the last week's games from the history before it. Every team's statistics
    are forecast to the day of its game (EMA W6 -> forest M5); home hitting meets away
    pitching and the reverse (J9), both scored by the win and the runs model of one
    pipeline (M4); the higher win score wins, a tie goes to the higher runs score, else NULL (F10)."""
    games, table, days = _upcoming(spark, d)
    model = M.fit_game_models(table, FEATURES, "win", "runs_scored")
    forecast = cut_lineage(_forecast(games, days).dropDuplicates(["game_pk", "team"]))
    m = games.join(matchup_scores(model, games, forecast), "game_pk", "left")
    return m.select("game_pk", "home_team", "away_team", round_half_up("home_score", 6).alias("home_score"), round_half_up("away_score", 6).alias("away_score"),
                    FN.winner_tiebreak("home_team", "away_team", "home_score", "away_score", "home_runs", "away_runs").alias("team_winner"))


def _backtest(spark, d, features):
    rows = TT.feature_table(spark, d).select("game_pk", "day", "is_home", "win", *features)
    scored = WF.walk_forward(rows, "day", features, F.col("win") * 2.0 - 1.0)
    return WF.backtest_games(scored, "game_pk", "day", "is_home", "win")


@register("backtest_walk_forward")
def backtest_walk_forward(spark, d):
    """M7: every game predicted by the win model (36 features) of the days before it, with the accuracy so far
    over the games that got a prediction."""
    games = store(_backtest(spark, d, FEATURES).withColumnRenamed("day", "game_date"))
    told = games.where("correct IS NOT NULL")
    seen = WN.running_accuracy(told, "game_date", "game_pk", "correct", skew_safe=True).select("game_pk", "games_so_far", "correct_so_far", "running_accuracy")
    return games.join(seen, "game_pk", "left").select("game_pk", "game_date", round_half_up("home_score", 6).alias("home_score"), round_half_up("away_score", 6).alias("away_score"),
                                                      "predicted", "home_won", "correct", F.col("games_so_far").cast("bigint").alias("games_so_far"), "running_accuracy")


@register("backtest_walk_single", TT.TABLE_SQL + f""", r AS (SELECT game_pk, day, CAST(is_home AS BOOLEAN) AS home, win, obp, 2.0e0 * win - 1.0e0 AS y FROM ft),
daily AS (SELECT day, COUNT(obp) AS n, COALESCE(SUM(obp), 0) AS x, COALESCE(SUM(obp * obp), 0) AS xx,
                 COALESCE(SUM(y) FILTER (WHERE obp IS NOT NULL), 0) AS y, COALESCE(SUM(obp * y), 0) AS xy FROM r GROUP BY day),
upto AS (SELECT day, SUM(n) OVER e AS n, SUM(x) OVER e AS x, SUM(xx) OVER e AS xx, SUM(y) OVER e AS y, SUM(xy) OVER e AS xy
         FROM daily WINDOW e AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT day, y / n AS y0, x / n AS x0, (xy - x * y / n) / (xx - x * x / n + 1.0e0) AS w FROM upto WHERE n > 0),
s AS (SELECT r.*, y0 + w * (obp - x0) AS score FROM r LEFT JOIN m ON m.day = r.day),
g AS (SELECT game_pk, day, MAX(score) FILTER (WHERE home) AS home_score, MAX(score) FILTER (WHERE NOT home) AS away_score,
             MAX(win) FILTER (WHERE home) = 1 AS home_won
      FROM s GROUP BY game_pk, day)
SELECT game_pk, day, {R('home_score', 6)} AS home_score, {R('away_score', 6)} AS away_score,
       CASE WHEN {R('home_score', 9)} <> {R('away_score', 9)} THEN home_score > away_score END AS predicted, home_won
FROM g""")
def backtest_walk_single(spark, d):
    """M7 with one feature, where each day's ridge has a closed form."""
    return _backtest(spark, d, ["obp"]).select("game_pk", "day", round_half_up("home_score", 6).alias("home_score"), round_half_up("away_score", 6).alias("away_score"), "predicted", "home_won")


@register("model_roundtrip", CUSTOMER_STATS_SQL + f"""
SELECT custkey, {R('regr_slope(runs, n_orders) OVER () * n_orders + regr_intercept(runs, n_orders) OVER ()', 2)} AS prediction
FROM cs""")
def model_roundtrip(spark, d):
    """M8: save the fitted model to the shared store, load it back and score."""
    data = M.assemble(customer_stats(spark, d), ["n_orders"])
    path = M.save_model(M.fit_ols(data, "runs"), shared_path(spark, "runs-model"))
    loaded = M.load_linear_model(path)
    return loaded.transform(data).select("custkey", round_half_up("prediction", 2).alias("prediction"))


@register("q_schedule_predictions", """
SELECT d.doc_id AS game_id, d.source AS home_name, d.lang AS away_name,
       CASE WHEN l.toxic = 1 THEN d.source WHEN l.toxic = 0 THEN d.lang END AS predicted_winner
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE d.n_chars > 0""")
def q_schedule_predictions(spark, d):
    """Q8: the day's schedule left-joined to stored predictions (documents as the
    schedule, labels as the prediction table)."""
    docs = load(spark, d, "documents").filter(F.col("n_chars") > 0).select(
        F.col("doc_id").alias("game_id"), F.col("source").alias("home_name"), F.col("lang").alias("away_name"))
    pred = load(spark, d, "labels").select("doc_id", "toxic")
    j = docs.join(pred, docs.game_id == pred.doc_id, "left")
    return j.select("game_id", "home_name", "away_name",
                    F.when(F.col("toxic") == 1, F.col("home_name")).when(F.col("toxic") == 0, F.col("away_name"))
                    .alias("predicted_winner"))
