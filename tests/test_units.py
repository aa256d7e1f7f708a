"""Hand-made edge cases per operator (NULLs, ties, empty input, one row,
zero denominators, duplicate keys, collisions, unordered input)."""

import datetime as dt
import math
import os
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from diamondlake.functions import scalars as FN
from diamondlake.operators import aggregates as A
from diamondlake.operators import joins as J
from diamondlake.operators import keys as K
from diamondlake.operators import ordering as O
from diamondlake.operators import projection as P
from diamondlake.operators import quality as Q
from diamondlake.operators import stats as ST
from diamondlake.operators import upsert as U
from diamondlake.operators import windows as WN
from diamondlake.sources import files as IO
from tests import reference_ema as REF


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


def test_conditional_counts_null_event(spark):
    df = spark.createDataFrame([(1, "click"), (1, None), (2, "error")], "u long, e string")
    out = A.conditional_counts(df, ["u"], "e", {"hits": ["click"], "pa": A.NOT_NULL, "none": []})
    assert rows(out, "u", "hits", "pa", "none") == [(1, 1, 1, 0), (2, 0, 1, 0)]


def test_guarded_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, None), (3.0, 2)], "n double, d int")
    assert [r[0] for r in df.select(FN.safe_ratio("n", "d", 4)).collect()] == [None, None, 1.5]


def test_round_half_up_is_ieee_deterministic(spark):
    df = spark.createDataFrame([(0.125,), (-2.5,), (2.5,), (1.0005,)], "x double")
    got = [r[0] for r in df.select(FN.round_half_up("x", 2)).collect()]
    assert got[:3] == [0.13, -2.5, 2.5]
    assert got[3] == math.floor(1.0005 * 100 + 0.5) / 100


@pytest.mark.parametrize("skew_safe", [False, True])
def test_streak_variants(spark, skew_safe):
    d = [dt.date(2024, 1, i) for i in range(1, 8)]
    hits = [1, 2, 0, 0, 0, 3, 1]          # hit, hit, none x3, hit, hit
    df = spark.createDataFrame([(7, d[i], hits[i]) for i in range(7)][::-1], "p long, g date, h long")
    any_state = WN.streaks(df, "p", "g", "h", as_written=True, skew_safe=skew_safe).collect()[0]["best_streak"]
    hits_only = WN.streaks(df, "p", "g", "h", as_written=False, skew_safe=skew_safe).collect()[0]["best_streak"]
    assert (any_state, hits_only) == (3, 2)


def test_streak_hitless_player(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, i), 0) for i in range(1, 4)], "p long, g date, h long")
    assert WN.streaks(df, "p", "g", "h", as_written=True).collect()[0]["best_streak"] == 3
    assert WN.streaks(df, "p", "g", "h", as_written=False).count() == 0


def test_latest_row_ties_broken_by_key(spark):
    df = spark.createDataFrame([(1, "2024-01-02", 5, "A"), (1, "2024-01-02", 9, "B"), (1, "2024-01-01", 99, "C")],
                               "k long, d string, o long, v string")
    assert rows(WN.latest_row(df, "k", ["d", "o"], ["v"]), "k", "v") == [(1, "B")]


def _pandas_ewm(vals, span=28):
    return pd.Series(vals, dtype="float64").ewm(span=span, adjust=False).mean().tolist()


@pytest.mark.parametrize("vals", [[1.0, 2.0, 3.0, 10.0], [None, 1.0, None, None, 5.0, 2.0], [4.0]])
def test_ema_matches_pandas_both_paths(spark, vals):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)][::-1], "t long, i long, x double")
    exp = _pandas_ewm(vals)
    got_p = [r["x_ema"] for r in REF.ema_pandas(df, "t", ["i"], ["x"], digits=None).orderBy("i").collect()]
    got_f = [r["x_ema"] for r in REF.ema_columns(df, "t", "i", ["x"]).orderBy("i").collect()]
    from diamondlake.operators.scan import ema_scan
    for parts in (1, 3):
        got_s = [r["x_ema"] for r in ema_scan(df, "t", ["i"], ["x"], digits=None, num_partitions=parts).orderBy("i").collect()]
        for e, v in zip(exp, got_s):
            assert (v is None) if (e is None or math.isnan(e)) else abs(e - v) < 1e-12
    for e, a, b in zip(exp, got_p, got_f):
        if e is None or (isinstance(e, float) and math.isnan(e)):
            assert a is None or math.isnan(a)
            assert b is None
        else:
            assert abs(e - a) < 1e-12 and abs(e - b) < 1e-12


def test_upsert_updates_inserts_and_keeps_columns(spark):
    t = spark.createDataFrame([(1, "a", 10.0, "X"), (2, "b", 20.0, "Y")], "k long, n string, v double, seg string")
    s = spark.createDataFrame([(2, "B", 25.0), (3, "c", 30.0)], "k long, n string, v double")
    out = U.upsert_by_key(t, s, ["k"], ["n", "v"])
    assert rows(out, "k", "n", "v", "seg") == [(1, "a", 10.0, "X"), (2, "B", 25.0, "Y"), (3, "c", 30.0, None)]
    again = U.upsert_by_key(out, s, ["k"], ["n", "v"])
    assert rows(again) == rows(out)   # idempotent


def test_upsert_late_duplicate_keeps_last(spark):
    t = spark.createDataFrame([(1, 1.0, 0)], "k long, v double, ver int")
    s = spark.createDataFrame([(1, 5.0, 2), (1, 3.0, 1)], "k long, v double, ver int")
    out = U.upsert_by_key(t, s, ["k"], ["v", "ver"], source_order=["ver"])
    assert rows(out) == [(1, 5.0, 2)]


def test_upsert_audit_columns(spark):
    t = spark.createDataFrame([(1, 1.0)], "k long, v double")
    s = spark.createDataFrame([(2, 2.0)], "k long, v double")
    out = U.upsert_by_key(t, s, ["k"], audit=True)
    assert set(out.columns) == {"k", "v", "created_at", "updated_at"}
    assert out.filter(F.col("created_at").isNull()).count() == 0


def test_anti_join_null_safe_and_normalised(spark):
    new = spark.createDataFrame([(1, " Ab "), (None, "x"), (3, "c")], "k long, s string")
    old = spark.createDataFrame([(1, "ab"), (None, "X ")], "k long, s string")
    out = J.join_anti_normalized(new, old, ["k", "s"], text_keys=["s"])
    assert rows(out, "k") == [(3,)]


def test_anti_plus_semi_is_input(spark):
    a = spark.range(0, 50).withColumnRenamed("id", "k")
    b = spark.range(10, 80, 3).withColumnRenamed("id", "k")
    anti = K.except_keys(a, b, ["k"])
    semi = a.join(b, "k", "left_semi")
    assert anti.count() + semi.count() == a.count()
    assert anti.join(semi, "k").count() == 0


def test_mirror_rows_doubles_games(spark):
    g = spark.createDataFrame([(1, "H", "A", 3, 2), (2, "A", "H", 1, 1)], "g long, h string, a string, hs int, as_ int")
    m = K.mirror_rows(g, ["g"], [{"team": "h", "opp": "a", "rs": "hs"}, {"team": "a", "opp": "h", "rs": "as_"}])
    assert m.count() == 2 * g.count()
    assert rows(m, "g", "team", "rs") == [(1, "A", 2), (1, "H", 3), (2, "A", 1), (2, "H", 1)]


def test_key_collision_detected(spark):
    df = spark.createDataFrame([(1, 11), (11, 1), (2, 3)], "a int, b int")
    r = K.key_collision_audit(df, ["a", "b"], sep="").collect()[0]
    assert (r["distinct_tuples"], r["distinct_keys"], r["collisions"]) == (3, 2, 1)
    assert K.key_collision_audit(df, ["a", "b"], sep="-").collect()[0]["collisions"] == 0


def test_dedup_keep_first_stable_under_repartition(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k long, o long, v string")
    a = rows(K.dedup_keep_first(df, ["k"], ["o"]))
    b = rows(K.dedup_keep_first(df.repartition(7), ["k"], ["o"]))
    assert a == b == [(1, 1, "a"), (2, 5, "z")]


def test_split_hash_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = rows(O.split_hash(df, ["k"]), "k", "split")
    b = rows(O.split_hash(df.repartition(13), ["k"]), "k", "split")
    assert a == b
    share = sum(1 for _, s in a if s == "train") / len(a)
    assert 0.75 < share < 0.85


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id long, c double, x double")
    assert rows(ST.minmax_scale(df, ["c", "x"], ["id"])) == [(1, 0.0, 0.0), (2, 0.0, 1.0)]


def test_classification_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = ST.classification_metrics(df, "y", "p").collect()[0]
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_linregress_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = 3 * x + 2 + rng.normal(scale=0.5, size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = ST.linregress_many(df, "y", ["x"], digits=10).collect()[0]
    slope, intercept = np.polyfit(x, y, 1)
    rr = np.corrcoef(x, y)[0, 1]
    se = math.sqrt((1 - rr ** 2) * np.var(y) / np.var(x) / (len(x) - 2))
    assert abs(r["slope"] - slope) < 1e-8 and abs(r["intercept"] - intercept) < 1e-8
    assert abs(r["r"] - rr) < 1e-8 and abs(r["stderr"] - se) < 1e-8


def test_ridge_classifier_matches_closed_form(spark):
    from diamondlake.operators import models as M
    rng = np.random.default_rng(7)
    X = rng.normal(size=(300, 3))
    ylab = (X @ np.array([1.0, -2.0, 0.5]) + rng.normal(scale=0.5, size=300) > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(l)) for (a, b, c), l in zip(X, ylab)],
                               "a double, b double, c double, y int")
    model = M.fit_ridge_classifier(M.assemble(df, ["a", "b", "c"]), "y", alpha=1.0)
    t = 2.0 * ylab - 1.0
    Xc, tc = X - X.mean(0), t - t.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(3), Xc.T @ tc)
    b = t.mean() - X.mean(0) @ w
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-6)
    assert abs(model.intercept - b) < 1e-6


def test_transition_probs_sum_to_one(spark):
    df = spark.createDataFrame([(1, "s", "a", "x", 1.0), (1, "s", "b", "y", 3.0), (1, "s", "a", "x", 2.0)],
                               "u long, st string, ev string, nx string, r double")
    out = A.transition_probs(df, "u", "st", "ev", "nx", "r")
    assert abs(sum(r["prob"] for r in out.collect()) - 1.0) < 1e-9
    assert rows(out, "ev", "avg_runs") == [("a", 1.5), ("b", 3.0)]


def test_scalar_functions(spark):
    df = spark.createDataFrame([("<a x>Name</a>", "Doe, John", "  two words here", "10.9%", "Élan çà")],
                               "h string, n string, t string, p string, a string")
    r = df.select(FN.anchor_text("h"), FN.swap_name("n"), FN.first_two_words("t"), FN.percent_to_fraction("p"),
                  FN.strip_accents("a")).collect()[0]
    assert tuple(r) == ("Name", "John Doe", "two words", 0.109, "Elan ca")
    none = spark.createDataFrame([("no tags", "bad%")], "h string, p string").select(
        FN.anchor_text("h"), FN.percent_to_fraction("p")).collect()[0]
    assert tuple(none) == (None, None)


def test_winner_tiebreak(spark):
    df = spark.createDataFrame([("H", "A", 2.0, 1.0, 0.0, 0.0), ("H", "A", 1.0, 1.0, 3.0, 2.0), ("H", "A", 1.0, 1.0, 2.0, 2.0)],
                               "h string, a string, hp double, ap double, hs double, as_ double")
    got = [r[0] for r in df.select(FN.winner_tiebreak("h", "a", "hp", "ap", "hs", "as_")).collect()]
    assert got == ["H", "H", None]


def test_filter_not_in_keeps_null(spark):
    df = spark.createDataFrame([("R",), ("S",), (None,)], "t string")
    got = [r[0] for r in P.filter_not_in(df, "t", ["S", "E"]).collect()]
    assert sorted(got, key=str) == sorted(["R", None], key=str)


def test_filter_text_exclude_null_kept(spark):
    df = spark.createDataFrame([(1, "has Secret"), (2, None), (3, "clean")], "id long, t string")
    assert sorted(r[0] for r in P.filter_text_exclude(df, "t", ["secret"]).collect()) == [2, 3]


def test_normalize_headers_rule():
    assert P.normalize_header("wRC+") == "wrc_plus"
    assert P.normalize_header("Player/Team Name?") == "player_team_name"


def test_scan_csv_empty_is_no_data(spark, tmp_path):
    schema = "a long, b string"
    empty = str(tmp_path / "none")
    os.makedirs(empty)
    assert IO.scan_csv(spark, empty, spark.createDataFrame([], schema).schema).count() == 0
    assert IO.scan_csv(spark, str(tmp_path / "missing"), spark.createDataFrame([], schema).schema).count() == 0


def test_season_guard():
    assert IO.season_bounds("2024-03-28", "2024-09-30")
    with pytest.raises(ValueError):
        IO.season_bounds("2024-09-01", "2025-04-01")


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "abc"), (1, None), (2, "toolongname")], "k long, s string")
    assert rows(Q.dq_unique(df, ["k"])) == [(1, 2)]
    assert rows(Q.dq_not_null(df, ["k", "s"])) == [("k", 0), ("s", 1)]
    assert rows(Q.dq_domain(df, {"s_len": Q.varchar_overflow("s", 5)})) == [("s_len", 1)]
    dim = spark.createDataFrame([(1,)], "id long")
    assert rows(Q.dq_foreign_key(df, "k", dim, "id"), "k") == [(2,)]


@pytest.mark.parametrize("skew_safe", [False, True])
def test_running_accuracy_matches_global_order(spark, skew_safe):
    data = [(dt.date(2024, 1, 1 + i // 3), i, i % 2 == 0) for i in range(12)]
    df = spark.createDataFrame(data[::-1], "d date, g long, c boolean")
    out = WN.running_accuracy(df, "d", "g", "c", skew_safe=skew_safe).orderBy("d", "g").collect()
    corr = 0
    for i, r in enumerate(out):
        corr += int(data[i][2])
        assert (r["games_so_far"], r["correct_so_far"]) == (i + 1, corr)


def test_plans_avoid_cartesian_and_use_group_limit(spark):
    from diamondlake.plans.catalog import queries
    from tests.conftest import SF_SMALL
    qs = queries()
    for k in ["q_weighted_leaders", "q_ops_leaders", "q_streaks", "join_star_left", "minmax_scale",
              "filter_threshold_scalar"]:
        plan = qs[k](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k
    top = O.topk_per_group_mean(spark.range(100).withColumn("g", F.col("id") % 3), "g", [F.desc("id")], 5, ["id"])
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_ema_scan_hot_entity_spanning_partitions(spark):
    import random
    from diamondlake.operators.scan import ema_scan
    rnd = random.Random(5)
    data = [(t, i, None if rnd.random() < 0.2 else rnd.uniform(0, 10)) for t, n in ((1, 400), (2, 2), (3, 50))
            for i in range(n)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "t long, i long, x double")
    pdf = pd.DataFrame(data, columns=["t", "i", "x"]).sort_values(["t", "i"])
    exp = {(t, i): e for t, g in pdf.groupby("t")
           for i, e in zip(g["i"], g["x"].astype(float).ewm(span=28, adjust=False).mean())}
    for parts in (5, 11):
        for r in ema_scan(df, "t", ["i"], ["x"], digits=None, num_partitions=parts).collect():
            e = exp[(r["t"], r["i"])]
            assert (r["x_ema"] is None) if math.isnan(e) else abs(r["x_ema"] - e) < 1e-9


def test_neighbours_match_pandas_shift(spark):
    import random
    from diamondlake.operators.prefix import neighbours
    rnd = random.Random(2)
    data = [(u, d, i, rnd.choice(["a", "b", None])) for u, n in ((1, 200), (2, 5), (3, 1)) for d in (1, 2) for i in range(n)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "u long, d long, i long, e string")
    pdf = pd.DataFrame(data, columns=list("udie")).sort_values(["u", "d", "i"])
    pdf["p"] = pdf.groupby(["u", "d"])["e"].shift(1)
    pdf["n"] = pdf.groupby(["u", "d"])["e"].shift(-1)
    exp = {(r.u, r.d, r.i): (None if pd.isna(r.p) else r.p, None if pd.isna(r.n) else r.n) for r in pdf.itertuples()}
    for size in (1, 7, 1000):
        got = neighbours(df, ["u", "d"], ["i"], "e", "prev", "next", bucket=F.floor(F.col("i") / size)).collect()
        assert len(got) == len(data)
        assert all(exp[(r.u, r.d, r.i)] == (r.prev, r.next) for r in got)


def test_cumulative_sums_and_skew_safe_windows_match_windows(spark):
    import random
    from diamondlake.operators.prefix import cumulative_sums
    rnd = random.Random(4)
    data = [(t, s, i, rnd.randint(0, 3), 1) for t, n in ((1, 150), (2, 3), (3, 1)) for s in (1, 2) for i in range(n)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "t long, s int, i long, w long, one int")
    pdf = pd.DataFrame(data, columns=["t", "s", "i", "w", "one"]).sort_values(["t", "s", "i"])
    exp = dict(zip(zip(pdf.t, pdf.s, pdf.i), pdf.groupby(["t", "s"])["w"].cumsum()))
    for size in (1, 6, 1000):
        got = cumulative_sums(df, ["t", "s"], ["i"], ["w"], rank_name="rk", bucket=F.floor(F.col("i") / size)).collect()
        assert all(exp[(r.t, r.s, r.i)] == r.cum_w for r in got)
    for inc in (True, False):
        a = rows(WN.running_ratio(df, ["t", "s"], ["i"], "w", "one", "x", inc), "t", "s", "i", "x")
        b = rows(WN.running_ratio(df, ["t", "s"], ["i"], "w", "one", "x", inc, skew_safe=True), "t", "s", "i", "x")
        assert a == b
        a = rows(WN.rolling_sum(df, "t", ["s", "i"], "w", "r", 10, inc), "t", "s", "i", "r")
        b = rows(WN.rolling_sum(df, "t", ["s", "i"], "w", "r", 10, inc, skew_safe=True), "t", "s", "i", "r")
        assert a == b
    a = rows(O.split_chronological(df, "t", ["s", "i"]), "t", "s", "i", "split")
    b = rows(O.split_chronological(df, "t", ["s", "i"], skew_safe=True), "t", "s", "i", "split")
    assert a == b


def test_exact_quantiles_of_large_groups(spark):
    """Groups beyond the size up to which every value is counted: many values, a hot value, NULL as group."""
    from diamondlake.operators import scan as SC
    n = 3 * SC.SMALL
    rows = spark.range(n).select(
        F.explode(F.array(*[F.struct(F.lit(g).alias("g"), v.cast("double").alias("v")) for g, v in (
            ("spread", F.pmod(F.xxhash64("id"), F.lit(10 ** 9)) / 7), ("tied", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 11)),
            (None, -F.exp(F.col("id") / 10000.0)))])).alias("s")).select("s.*")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in SC.exact_quantiles(rows, "g", "v", probs).collect()}
    pdf = rows.toPandas()
    for g in ("spread", "tied", None):
        vals = pdf.loc[pdf["g"].isna() if g is None else pdf["g"] == g, "v"].to_numpy()
        for p in probs:
            want = float(np.quantile(vals, p))
            assert abs(got[(g, p)] - want) <= 1e-9 * max(1.0, abs(want)), (g, p)


def test_describe_takes_three_exchanges_and_no_checkpoint(spark):
    from diamondlake.plans import catalog
    df = catalog.queries()["describe_columns"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bExchange (?:hash|range|Single)", plan)) <= 3
    assert "ExistingRDD" not in plan and "Python" not in plan
    gone = A.describe_columns(spark.createDataFrame([(1, None), (2, None)], "a long, b double"), ["a", "b"])
    assert {r["column_name"]: (r["count"], r["p50"]) for r in gone.collect()} == {"a": (2, 1.5), "b": (0, None)}


def test_slope_p_value_matches_the_integral(spark):
    import math

    def tail(low, k):      # integral of cos(t)^k from low, over the part that isn't negligible
        high = min(math.pi / 2, low + 60 / math.sqrt(max(k, 1)))
        at, w = np.polynomial.legendre.leggauss(400)
        t = low + (at + 1) / 2 * (high - low)
        return float((w * np.exp(k * np.log(np.maximum(np.cos(t), 1e-300)))).sum()) * (high - low)
    cases = [(r, n) for n in (3, 4, 5, 8, 30, 70, 200, 5000, 10 ** 6) for r in (0.0, 0.3, -0.5, -0.7, 0.99, 1e-3, 0.02, 2 / math.sqrt(n + 10), 6 / math.sqrt(n + 40))]
    df = spark.createDataFrame([*cases, (1.0, 9), (0.5, 2), (None, 9)], "r double, n long")
    got = {(x["r"], x["n"]): x["p"] for x in df.select("r", "n", ST.correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()}
    for r, n in cases:
        want = tail(math.asin(abs(r)), n - 3) / tail(0.0, n - 3) if n > 3 else 1 - 2 * math.asin(abs(r)) / math.pi
        assert abs(got[(r, n)] - want) < 1e-9, (r, n)
    assert got[(1.0, 9)] == 0 and got[(0.5, 2)] is None and got[(None, 9)] is None
    xy = spark.createDataFrame([(float(i), float((i * 7919) % 101)) for i in range(200)], "x double, y double")
    fit, r = ST.linregress_many(xy, "y", ["x"], digits=2, p_digits=9).first(), float(np.corrcoef([i for i in range(200)], [(i * 7919) % 101 for i in range(200)])[0, 1])
    assert abs(fit["p_value"] - tail(math.asin(abs(r)), 197) / tail(0.0, 197)) < 1e-8


def test_exact_quantiles_match_numpy(spark):
    import random
    from diamondlake.operators.scan import exact_quantiles
    rnd = random.Random(9)
    data = [("hot", float(rnd.randint(0, 40))) for _ in range(500)] + [("one", 3.5)] + \
           [("small", v) for v in (1.0, None, 2.0, 10.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for parts in (1, 7):
        got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, "g", "v", probs, num_partitions=parts).collect()}
        for g in ("hot", "one", "small"):
            vals = [v for gg, v in data if gg == g and v is not None]
            for p in probs:
                assert abs(got[(g, p)] - float(np.percentile(vals, p * 100))) < 1e-9


def test_stream_upsert_replay_and_new_file(spark, tmp_path):
    from diamondlake.streaming.upsert_stream import init_snapshot, stream_upsert
    root = str(tmp_path)
    landing, base, ckpt = f"{root}/landing", f"{root}/table", f"{root}/_ckpt"
    schema = "k long, v double"
    init_snapshot(spark.createDataFrame([(1, 1.0), (2, 2.0)], schema), base)
    spark.createDataFrame([(2, 20.0), (3, 30.0)], schema).coalesce(1).write.mode("append").parquet(landing)
    first = stream_upsert(spark, landing, spark.createDataFrame([], schema).schema, base, ckpt, ["k"])
    assert rows(spark.read.parquet(first)) == [(1, 1.0), (2, 20.0), (3, 30.0)]
    again = stream_upsert(spark, landing, spark.createDataFrame([], schema).schema, base, ckpt, ["k"])
    assert again == first                                  # replay: nothing new, same snapshot
    spark.createDataFrame([(1, 10.0)], schema).coalesce(1).write.mode("append").parquet(landing)
    third = stream_upsert(spark, landing, spark.createDataFrame([], schema).schema, base, ckpt, ["k"])
    assert rows(spark.read.parquet(third)) == [(1, 10.0), (2, 20.0), (3, 30.0)]


def test_plans_push_filters_prune_columns_and_broadcast_bounded_dims(spark):
    from diamondlake.plans.catalog import queries
    from tests.conftest import SF_SMALL
    qs = queries()
    plan = qs["q_weighted_leaders"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01" in plan and "LessThan(ts,2024-02-01" in plan
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    star = qs["join_star_left"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert star.count("BroadcastExchange") >= 2        # nation and region (bounded dims)


def test_reading_one_season_prunes_the_others(spark):
    from diamondlake.sources import files as IO
    from tests.conftest import SF_SMALL
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", F.year("o_orderdate").alias("season"))
    path = IO.shared_path(spark, "one-season")
    IO.write_warehouse(orders, path, ["season"])
    one = spark.read.parquet(path).where("season = 1996")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "(season#" in plan
    assert one.count() == orders.where("season = 1996").count() > 0


def test_nested_sources_edge_cases(spark):
    from pyspark.sql.types import LongType, StringType, StructType
    from diamondlake.sources import nested as N
    item = StructType().add("id", LongType()).add("name", StringType())
    df = spark.createDataFrame([(1, '{"data":[{"id":7,"name":"a"},{"id":8,"name":"b"}]}'), (2, '{"status":"none"}'),
                                (3, "not json"), (4, None)], "k long, j string")
    got = rows(N.json_rows(df, "j", item, {"pid": "id", "nm": "name"}, keep=["k"]))
    assert got == [(1, 7, "a"), (1, 8, "b")]
    box = ('{"teamInfo":{"home":{"abbreviation":"H"},"away":{"abbreviation":"A"}},'
           '"homeBatters":[{"personId":1,"battingOrder":"100","name":"x"},{"personId":2,"battingOrder":"101","name":"y"}],'
           '"awayBatters":[{"personId":3,"battingOrder":"200","name":"z"}]}')
    from diamondlake.plans.nested import BOX
    b = rows(N.boxscore_lineups(spark.createDataFrame([(9, box)], "g long, b string"), "b", BOX, keep=["g"]))
    assert b == [(9, "away", "A", 3, "z", "2"), (9, "home", "H", 1, "x", "1")]
    html = "<ul><li>Header</li><li><a href=\"/p1\">One</a></li><li><a href=\"/p2\"> 2.5 </a></li></ul>"
    r = N.html_rows(spark.createDataFrame([(1, html)], "id long, h string"), "h", r"<li>(.*?)</li>", keep=["id"])
    cells = r.select("id", "row_idx", N.html_cells(F.col("row_html"), r'(?:href="|>)([^"<>]+)').alias("c"))
    typed = N.cells_typed(cells, "c", {"link": (0, "string"), "label": (1, "string"), "num": (1, "double")})
    assert rows(typed) == [(1, 1, "/p1", "One", None), (1, 2, "/p2", "2.5", 2.5)]


def test_stream_upsert_partitioned_rewrites_only_touched_partitions(spark, tmp_path):
    import glob
    from diamondlake.streaming.upsert_stream import stream_upsert_partitioned
    root = str(tmp_path)
    table, landing, ckpt = f"{root}/t", f"{root}/landing", f"{root}/_ckpt"
    schema = "season int, k long, v double"
    spark.createDataFrame([(2023, 1, 1.0), (2023, 2, 2.0), (2024, 1, 5.0)], schema).write.partitionBy(
        "season").parquet(table)
    before_2023 = sorted(glob.glob(f"{table}/season=2023/*.parquet"))
    spark.createDataFrame([(2024, 1, 50.0), (2024, 3, 30.0)], schema).coalesce(1).write.parquet(landing)
    stream_upsert_partitioned(spark, landing, spark.createDataFrame([], schema).schema, table, ckpt,
                              ["season", "k"], "season", ["v"])
    got = sorted(tuple(r) for r in spark.read.parquet(table).select("season", "k", "v").collect())
    assert got == [(2023, 1, 1.0), (2023, 2, 2.0), (2024, 1, 50.0), (2024, 3, 30.0)]
    assert sorted(glob.glob(f"{table}/season=2023/*.parquet")) == before_2023     # untouched partition kept


def test_scans_treat_null_entity_as_one_group(spark):
    from diamondlake.operators.prefix import cumulative_sums, neighbours
    from diamondlake.operators.scan import ema_scan
    data = [(None if i < 30 else 1, i, float(i % 4), "abc"[i % 3]) for i in range(40)]
    df = spark.createDataFrame(data, "t long, i long, x double, e string")
    pdf = pd.DataFrame(data, columns=["t", "i", "x", "e"])
    pdf["grp"] = pdf["t"].fillna(-1)
    pdf = pdf.sort_values(["grp", "i"])
    cs = {(r["t"], r["i"]): r["cum_x"] for r in cumulative_sums(df, ["t"], ["i"], ["x"], bucket=F.floor(F.col("i") / 6)).collect()}
    em = {(r["t"], r["i"]): r["x_ema"] for r in ema_scan(df, "t", ["i"], ["x"], digits=None, num_partitions=6).collect()}
    nb = {(r["t"], r["i"]): r["p"] for r in neighbours(df, ["t"], ["i"], "e", "p", "n", bucket=F.floor(F.col("i") / 6)).collect()}
    for g, grp in pdf.groupby("grp"):
        t = None if g == -1 else int(g)
        for i, c, e, p in zip(grp["i"], grp["x"].cumsum(), grp["x"].ewm(span=28, adjust=False).mean(), grp["e"].shift(1)):
            assert cs[(t, i)] == c and abs(em[(t, i)] - e) < 1e-12
            assert nb[(t, i)] == (None if pd.isna(p) else p)


def test_model_save_load_predictions_equal(spark, tmp_path):
    from diamondlake.operators import models as M
    df = spark.createDataFrame([(float(i), 2.0 * i + 1.0 + (i % 3) * 0.1) for i in range(50)], "x double, y double")
    data = M.assemble(df, ["x"])
    model = M.fit_ols(data, "y")
    path = M.save_model(model, str(tmp_path / "m"))
    before = [r["prediction"] for r in model.transform(data).orderBy("x").collect()]
    after = [r["prediction"] for r in M.load_linear_model(path).transform(data).orderBy("x").collect()]
    assert before == after


def test_real_vocabulary_rate_stats(spark):
    from diamondlake.functions.vocab import batting_categories
    ev = ["single", "double", "home_run", "strikeout", "walk", "sac_fly", "field_out", None, "hit_by_pitch", "triple"]
    df = spark.createDataFrame([(1, e) for e in ev], "batter long, events string")
    c = A.conditional_counts(df, ["batter"], "events", batting_categories())
    r = A.rate_stats(c, extra_walks=None).collect()[0]
    # hits 4 (1B 2B 3B HR), at bats 6 (+K, field out), on base 6 (+BB, HBP), walks 2, sac fly 1, PA 9
    assert (r["hit_count"], r["total_ab"], r["num_obp"], r["walks"], r["sf"], r["num_pa"]) == (4, 6, 6, 2, 1, 9)
    assert (r["ba"], r["slg"], r["obp"]) == (0.6667, round((1 + 2 + 3 + 4) / 6, 4), round(6 / 9, 4))


def test_sql_entry_point_with_named_parameters(spark):
    from diamondlake.plans.catalog import queries
    from diamondlake.sources.sql_api import run_sql
    from tests.conftest import SF_SMALL
    text = """
    SELECT user_id AS batter_id, CAST(ts AS DATE) AS game_date,
           COUNT_IF(event_type = 'click') AS num_singles, COUNT_IF(event_type = 'view') AS num_doubles,
           COUNT_IF(event_type = 'signup') AS num_triples, COUNT_IF(event_type = 'purchase') AS num_hrs
    FROM events WHERE ts >= :start AND ts < :stop
    GROUP BY user_id, CAST(ts AS DATE)
    HAVING num_singles > 0 AND num_doubles > 0 AND num_triples > 0 AND num_hrs > 0"""
    got = run_sql(spark, SF_SMALL, text, start=dt.datetime(2024, 1, 1), stop=dt.datetime(2024, 2, 1))
    ref = queries()["agg_all_categories"](spark, SF_SMALL)
    assert rows(got) == rows(ref)


def test_upsert_snapshot_versions(spark, tmp_path):
    from diamondlake.streaming.upsert_stream import current_snapshot, init_snapshot, upsert_snapshot
    base = str(tmp_path / "dim")
    init_snapshot(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double"), base)
    p1 = upsert_snapshot(spark, base, spark.createDataFrame([(2, 9.0), (3, 3.0)], "k long, v double"), ["k"])
    assert p1.endswith("v1") and current_snapshot(spark, base) == p1
    assert rows(spark.read.parquet(p1)) == [(1, 1.0), (2, 9.0), (3, 3.0)]
    assert rows(spark.read.parquet(f"{base}/v0")) == [(1, 1.0), (2, 2.0)]       # previous snapshot untouched


def test_lag_lead_skew_safe_match_windows(spark):
    data = [(g, i, f"s{(g * 7 + i) % 5}") for g in (1, 2, 3) for i in range(25 if g == 1 else 4)]
    df = spark.createDataFrame(data, "g long, i long, v string")
    for fn in (WN.lag_value, WN.lead_value):
        a = rows(fn(df, ["g"], ["i"], "v", "x"), "g", "i", "x")
        b = rows(fn(df, ["g"], ["i"], "v", "x", skew_safe=True), "g", "i", "x")
        assert a == b


def test_checkpoint_dir_is_required_on_a_cluster():
    from diamondlake import session
    assert session._one_machine("local") and session._one_machine("local[4]")
    assert not session._one_machine("local-cluster[2,1,1024]") and not session._one_machine("yarn")


def test_strip_accents_folds_every_letter_with_a_decomposition(spark, duck):
    from diamondlake.functions import scalars as FN
    letters = [chr(c) for c in range(0xC0, 0x2000)]
    df = spark.createDataFrame([(x,) for x in [*letters, "o\u0308", "a", None, "", "Ærø ŁÓDŹ ǽ ß"]], "x string")
    got = {r["x"]: r["y"] for r in df.select("x", FN.strip_accents("x").alias("y")).collect()}
    assert got["o\u0308"] == "o" and got[None] is None and got[""] == "" and got["Ærø ŁÓDŹ ǽ ß"] == "AEro LODZ ae ss"
    plain = set(FN.PLAIN_LETTERS) | set(FN.TWO_LETTERS) | set(FN.MARKS) | set("ǢǣǼǽǾǿẛ")
    import unicodedata
    for x in letters:
        parts = unicodedata.normalize("NFD", x)
        # vowel signs of Indic scripts have no combining class: they aren't accents
        if x not in plain and unicodedata.category(x)[0] == "L" and len(parts) > 1 and all(map(unicodedata.combining, parts[1:])):
            assert got[x] == duck.execute("SELECT strip_accents(?)", [x]).fetchone()[0], hex(ord(x))
