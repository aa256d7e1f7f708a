"""Property tests (hypothesis) against brute-force Python on small inputs."""

import datetime as dt
import itertools

from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from diamondlake.operators import keys as K
from diamondlake.operators import upsert as U
from diamondlake.operators import windows as WN

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50)), min_size=0, max_size=15)


@SETTINGS
@given(target=rows_st, batch=st.lists(st.tuples(st.integers(0, 9), st.integers(0, 50), st.integers(0, 3)),
                                      min_size=1, max_size=10))
def test_upsert_matches_dict_semantics(spark, target, batch):
    tgt = {}
    for k, v in target:
        tgt.setdefault(k, v)           # target keys are unique
    latest = {}
    for k, v, ver in sorted(batch, key=lambda r: (r[0], r[2], r[1])):
        latest[k] = (v, ver)           # keep last by (ver, v) within the batch
    expected = dict(tgt)
    expected.update({k: v for k, (v, _) in latest.items()})
    t = spark.createDataFrame([(k, v, 0) for k, v in tgt.items()], "k long, v long, ver long")
    b = spark.createDataFrame(batch, "k long, v long, ver long")
    out = U.upsert_by_key(t, b, ["k"], ["v"], source_order=["ver", "v"])
    got = {r["k"]: r["v"] for r in out.collect()}
    assert got == expected
    again = U.upsert_by_key(out, b, ["k"], ["v"], source_order=["ver", "v"])
    assert {r["k"]: r["v"] for r in again.collect()} == expected


@SETTINGS
@given(a=st.lists(st.integers(0, 20), max_size=20), b=st.lists(st.integers(0, 20), max_size=20))
def test_anti_and_semi_partition_input(spark, a, b):
    da = spark.createDataFrame([(x,) for x in a], "k long")
    db = spark.createDataFrame([(x,) for x in b], "k long")
    anti = sorted(r[0] for r in K.except_keys(da, db, ["k"]).collect())
    semi = sorted(r[0] for r in da.join(db, "k", "left_semi").collect())
    assert sorted(anti + semi) == sorted(a)
    assert anti == sorted(x for x in a if x not in set(b))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.text("abc", max_size=2)), max_size=25),
       parts=st.integers(1, 5))
def test_dedup_keep_first_matches_sorted_first(spark, rows, parts):
    df = spark.createDataFrame(rows, "k long, o long, v string").repartition(parts)
    got = sorted(tuple(r) for r in K.dedup_keep_first(df, ["k"], ["o", "v"]).collect())
    exp = sorted((k, *min((o, v) for kk, o, v in rows if kk == k)) for k in {r[0] for r in rows})
    assert got == exp


def _runs(states):
    return [len(list(g)) for _, g in itertools.groupby(states)]


@SETTINGS
@given(hits=st.lists(st.integers(0, 2), min_size=1, max_size=20))
def test_streaks_match_brute_force(spark, hits):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=i), h) for i, h in enumerate(hits)]
    df = spark.createDataFrame(rows[::-1], "p long, g date, h long")
    states = [h > 0 for h in hits]
    hit_runs = [len(list(g)) for s, g in itertools.groupby(states) if s]
    for skew_safe in (False, True):
        any_state = WN.streaks(df, "p", "g", "h", as_written=True, skew_safe=skew_safe).collect()[0]["best_streak"]
        assert any_state == max(_runs(states))
        got = WN.streaks(df, "p", "g", "h", as_written=False, skew_safe=skew_safe).collect()
        assert (got[0]["best_streak"] if got else 0) == (max(hit_runs) if hit_runs else 0)


@SETTINGS
@given(vals=st.lists(st.tuples(st.sampled_from("abc"), st.integers(-50, 50)), min_size=1, max_size=40),
       parts=st.integers(1, 6))
def test_exact_quantiles_match_numpy(spark, vals, parts):
    import numpy as np
    from diamondlake.operators.scan import exact_quantiles
    df = spark.createDataFrame([(g, float(v)) for g, v in vals], "g string, v double")
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, "g", "v", [0.1, 0.5, 0.9], parts).collect()}
    for g in {g for g, _ in vals}:
        xs = [float(v) for gg, v in vals if gg == g]
        for p in (0.1, 0.5, 0.9):
            assert abs(got[(g, p)] - float(np.percentile(xs, p * 100))) < 1e-9


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=40),
       size=st.integers(1, 6))
def test_cumulative_sums_match_python(spark, vals, size):
    from diamondlake.operators.prefix import cumulative_sums
    rows = [(g, i, v) for i, (g, v) in enumerate(vals)]
    df = spark.createDataFrame(rows, "g long, i long, v long")
    got = {(r["g"], r["i"]): (r["cum_v"], r["rk"]) for r in
           cumulative_sums(df, ["g"], ["i"], ["v"], rank_name="rk", bucket=F.floor(F.col("i") / size)).collect()}
    run, cnt = {}, {}
    for g, i, v in rows:
        run[g] = run.get(g, 0) + v
        cnt[g] = cnt.get(g, 0) + 1
        assert got[(g, i)] == (run[g], cnt[g])
