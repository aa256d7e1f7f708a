"""Rolling-origin evaluation against a plain refit before every day."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from diamondlake.operators import walk_forward as WF

FEATURES = ["a", "b", "c"]


def _rows(n=240, days=12):
    rnd = random.Random(3)
    out = []
    for i in range(n):
        x = [rnd.gauss(0.3, 0.1), rnd.gauss(4, 2), rnd.random()]
        # A third of the rows fall on one day.
        day = dt.date(2024, 4, 1) + dt.timedelta(days=5 if i % 3 == 0 else rnd.randrange(days))
        out.append((i, day, *x, float(x[0] * 3 + x[1] * 0.1 + rnd.gauss(0, 0.3) > 1.3)))
    out[7] = (7, out[7][1], None, 1.0, 1.0, 1.0)
    out[8] = (8, None, 0.1, 1.0, 1.0, 1.0)
    out[9] = (9, out[9][1], 0.1, float("nan"), 1.0, 0.0)
    return out


def test_scores_equal_a_refit_before_every_day(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "i long, day date, a double, b double, c double, win double")
    label = F.col("win") * 2 - 1
    for parts in (1, 5):
        got = {r["i"]: r["score"] for r in WF.walk_forward(df.repartition(parts), "day", FEATURES, label, alpha=2.0).collect()}
        assert len(got) == len(rows)
        whole = [r for r in rows if r[1] is not None and all(v is not None and v == v for v in r[2:5])]
        for r in rows:
            before = [q for q in whole if r[1] is not None and q[1] < r[1]]
            if r not in whole or not before:
                assert got[r[0]] is None
                continue
            x, y = np.array([q[2:5] for q in before]), np.array([2 * q[5] - 1 for q in before])
            xc, yc = x - x.mean(0), y - y.mean()
            w = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(3), xc.T @ yc)
            assert abs(got[r[0]] - (y.mean() + (np.array(r[2:5]) - x.mean(0)) @ w)) < 1e-9


def test_games_without_history_a_tie_and_an_empty_table(spark):
    kind = "game long, day date, home int, win int, score double"
    d = dt.date(2024, 4, 1)
    games = WF.backtest_games(spark.createDataFrame([(1, d, 1, 1, 0.2), (1, d, 0, 0, 0.1), (2, d, 1, 0, 0.2), (2, d, 0, 1, 0.2), (3, d, 1, 1, None), (3, d, 0, 0, 0.4),
                                                    (4, d, 1, 1, 0.1 + 0.2), (4, d, 0, 0, 0.3)], kind), "game", "day", "home", "win")
    assert {r["game"]: (r["predicted"], r["home_won"], r["correct"]) for r in games.collect()} == {1: (True, True, True), 2: (None, False, None), 3: (None, True, None), 4: (None, True, None)}
    empty = spark.createDataFrame([], "i long, day date, a double, b double, c double, win double")
    assert WF.walk_forward(empty, "day", FEATURES, F.col("win")).count() == 0
