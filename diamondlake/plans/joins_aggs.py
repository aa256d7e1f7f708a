"""Joins, profiles, statistics and evaluation queries over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up, round_half_up_sql as R
from diamondlake.operators import aggregates as A
from diamondlake.operators import joins as J
from diamondlake.operators import stats as ST
from diamondlake.operators.windows import partition_avg_max
from diamondlake.plans.catalog import register
from diamondlake.sources.tables import load

# ---------------------------------------------------------------- Q1 / W1

PITCHER_PATTERN = "%Supplier%"   # narrows to one pitcher in use; the registered query keeps all


@register("q_entity_log", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.s_name AS pitcher_name,
       l.l_returnflag AS pitch_type, l.l_quantity AS release_speed, l.l_extendedprice AS release_spin_rate,
       l.l_linestatus AS description,
       {R('AVG(l.l_quantity) OVER (PARTITION BY l.l_returnflag)', 4)} AS avg_pitch_type_speed,
       MAX(l.l_quantity) OVER (PARTITION BY l.l_returnflag) AS max_pitch_type_speed
FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE s.s_name LIKE '{PITCHER_PATTERN}'""")
def q_entity_log(spark, d, pattern: str = PITCHER_PATTERN):
    """Q1: pitch log of the matching pitchers with per-pitch-type mean/max speed
    (the WHERE runs before the per-type aggregates, as in SQL)."""
    li = load(spark, d, "lineitem")
    sup = load(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("pitcher_name"))
    log = (li.join(sup, li.l_suppkey == sup.s_suppkey, "left").filter(F.col("pitcher_name").like(pattern))
           .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pitcher_name",
                   F.col("l_returnflag").alias("pitch_type"), F.col("l_quantity").alias("release_speed"),
                   F.col("l_extendedprice").alias("release_spin_rate"), F.col("l_linestatus").alias("description")))
    return partition_avg_max(log, "pitch_type", "release_speed", "avg_pitch_type_speed", "max_pitch_type_speed")


@register("win_partition_avg_max", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       {R('AVG(l_extendedprice) OVER (PARTITION BY l_suppkey)', 4)} AS avg_price_supplier,
       MAX(l_extendedprice) OVER (PARTITION BY l_suppkey) AS max_price_supplier
FROM lineitem""")
def win_partition_avg_max(spark, d):
    """AVG and MAX over a partition without ORDER BY."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return partition_avg_max(li, "l_suppkey", "l_extendedprice", "avg_price_supplier", "max_price_supplier")


# ---------------------------------------------------------------- regression table (customer level)

PREDICTORS = ["n_orders", "n_urgent", "n_fulfilled", "n_lines", "qty", "n_returned", "acctbal",
              "avg_discount", "max_price", "n_priority_low"]


def customer_stats(spark, d):
    """Per-customer aggregates of orders and lineitem.  Lines are aggregated per
    order *before* the join so the join sees one row per order."""
    per_order = load(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"), F.sum("l_discount").alias("disc"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    o = load(spark, d, "orders")
    j = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    per = j.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_fulfilled"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("n_priority_low"),
        F.sum(F.coalesce("n_lines", F.lit(0))).alias("n_lines"), F.sum("qty").alias("qty"),
        F.sum("disc").alias("disc"), F.sum(F.coalesce("n_returned", F.lit(0))).alias("n_returned"),
        F.max("o_totalprice").alias("max_price"), F.sum("o_totalprice").alias("price"))
    cust = load(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("acctbal"))
    out = per.join(cust, per.o_custkey == cust.c_custkey)
    return out.select(F.col("o_custkey").alias("custkey"), "n_orders", "n_urgent", "n_fulfilled", "n_priority_low",
                      "n_lines", "qty", "n_returned", "acctbal", "max_price",
                      F.try_divide(F.col("disc"), F.col("n_lines")).alias("avg_discount"),
                      round_half_up(F.col("price") / 1000, 2).alias("runs"))


CUSTOMER_STATS_SQL = f"""
WITH li AS (
  SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS qty, SUM(l_discount) AS disc,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY l_orderkey),
per AS (
  SELECT o_custkey, COUNT(*) AS n_orders, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
         COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_fulfilled,
         COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_priority_low,
         SUM(COALESCE(li.n_lines, 0)) AS n_lines, SUM(li.qty) AS qty, SUM(li.disc) AS disc,
         SUM(COALESCE(li.n_returned, 0)) AS n_returned, MAX(o_totalprice) AS max_price, SUM(o_totalprice) AS price
  FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey GROUP BY o_custkey),
cs AS (
  SELECT per.o_custkey AS custkey, n_orders, n_urgent, n_fulfilled, n_priority_low, n_lines, qty, n_returned,
         c.c_acctbal AS acctbal, max_price, disc / n_lines AS avg_discount, {R('price / 1000', 2)} AS runs
  FROM per JOIN customer c ON c.c_custkey = per.o_custkey)"""


def _linregress_sql(y: str, preds: list[str]) -> str:
    parts = []
    for p in preds:
        parts.append(f"""
  SELECT '{p}' AS predictor, regr_slope({y}, {p}) AS slope, regr_intercept({y}, {p}) AS intercept,
         corr({p}, {y}) AS r, regr_count({y}, {p}) AS n, regr_sxx({y}, {p}) AS sxx, regr_syy({y}, {p}) AS syy
  FROM cs""")
    return CUSTOMER_STATS_SQL + ",\nlr AS (" + "\n  UNION ALL".join(parts) + ")"


LINREGRESS_SELECT = f"""
SELECT predictor, {R('slope', 4)} AS slope, {R('intercept', 4)} AS intercept, {R('r', 4)} AS r,
       {R('CASE WHEN n > 2 AND sxx > 0 THEN SQRT((1.0 - r * r) * syy / sxx / (n - 2)) END', 4)} AS stderr,
       CAST(n AS BIGINT) AS n
FROM lr"""


@register("linregress_many", _linregress_sql("runs", PREDICTORS) + LINREGRESS_SELECT)
def linregress_many(spark, d):
    """A10: ten simple regressions of runs on each stat in one aggregation."""
    return ST.linregress_many(customer_stats(spark, d), "runs", PREDICTORS)


# Student's tail as a ratio of two integrals of cos(t)^(n-3), by Simpson's rule over POINTS steps.
POINTS = 20000


def _tail_sql(low: str) -> str:
    width = f"((PI() / 2 - {low}) / {POINTS})"
    weight = f"CASE WHEN i IN (0, {POINTS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(SUM({weight} * POW(GREATEST(COS({low} + i * {width}), 0.0e0), CAST(n AS DOUBLE) - 3)) * ANY_VALUE({width}))"


@register("linregress_p_values", _linregress_sql("runs", PREDICTORS) + f""",
pv AS (SELECT predictor, {_tail_sql('ASIN(LEAST(ABS(r), 1.0e0))')} / {_tail_sql('0.0e0')} AS p_value
       FROM lr, range(0, {POINTS + 1}) AS t(i) WHERE n > 3 GROUP BY predictor)
SELECT t.*, {R('pv.p_value', 6)} AS p_value FROM ({LINREGRESS_SELECT}) t LEFT JOIN pv USING (predictor)""")
def linregress_p_values(spark, d):
    """A10 with the two-sided p-value of each slope."""
    return ST.linregress_many(customer_stats(spark, d), "runs", PREDICTORS, p_digits=6)


@register("q_stat_usefulness", _linregress_sql("runs", PREDICTORS) + f"""
SELECT predictor, r, slope, intercept, ROW_NUMBER() OVER (ORDER BY r DESC, predictor) AS rank
FROM ({LINREGRESS_SELECT}) t
ORDER BY rank""")
def q_stat_usefulness(spark, d):
    """Q7: which stat explains runs best, ranked by r.  The ranking window is
    over one row per predictor (bounded), so its single partition is tiny."""
    lr = linregress_many(spark, d)
    return lr.select("predictor", "r", "slope", "intercept", F.row_number().over(
        Window.orderBy(F.desc("r"), "predictor")).cast("bigint").alias("rank")).orderBy("rank")


SCALE_COLS = ["n_orders", "n_lines", "qty", "acctbal", "max_price"]


def _minmax_sql() -> str:
    def mn(c):
        return f"(SELECT MIN({c}) FROM cs)"

    def mx(c):
        return f"(SELECT MAX({c}) FROM cs)"
    cols = ", ".join(f"CASE WHEN {mx(c)} = {mn(c)} THEN 0.0 ELSE {R(f'({c} - {mn(c)}) / ({mx(c)} - {mn(c)})', 4)} END AS {c}"
                     for c in SCALE_COLS)
    return CUSTOMER_STATS_SQL + f"\nSELECT custkey, {cols}\nFROM cs"


@register("minmax_scale", _minmax_sql())
def minmax_scale(spark, d):
    """Min-max scaling of feature columns to [0, 1]."""
    return ST.minmax_scale(customer_stats(spark, d), SCALE_COLS, ["custkey"])


@register("metrics_classification", f"""
WITH g AS (
  SELECT COUNT(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, COUNT(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp,
         COUNT(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn, COUNT(*) FILTER (WHERE quality = 0 AND toxic = 0) AS tn
  FROM labels),
m AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS p,
            CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS rc FROM g)
SELECT tp, fp, fn, tn,
       {R('CASE WHEN tp + fp + fn + tn > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) ELSE 0.0 END', 4)} AS accuracy,
       {R('p', 4)} AS precision, {R('rc', 4)} AS recall,
       {R('CASE WHEN p + rc > 0 THEN 2 * p * rc / (p + rc) ELSE 0.0 END', 4)} AS f1
FROM m""")
def metrics_classification(spark, d):
    """Accuracy / precision / recall / F1 of a 0/1 prediction (toxic) vs truth (quality)."""
    return ST.classification_metrics(load(spark, d, "labels"), "quality", "toxic")


ORDER_PRED_SQL = """
WITH p AS (SELECT l_orderkey, SUM(l_extendedprice * (1 + l_tax) * (1 - l_discount)) / 1000 AS pred
           FROM lineitem GROUP BY l_orderkey),
e AS (SELECT o_totalprice / 1000 AS y, COALESCE(p.pred, 0.0) AS pred FROM orders o LEFT JOIN p ON p.l_orderkey = o.o_orderkey)"""


@register("metrics_regression", ORDER_PRED_SQL + f"""
SELECT {R('AVG(ABS(y - pred))', 4)} AS mae, {R('AVG((y - pred) * (y - pred))', 4)} AS mse,
       {R('1 - SUM((y - pred) * (y - pred)) / (VAR_POP(y) * COUNT(y))', 4)} AS r2
FROM e""")
def metrics_regression(spark, d):
    """MAE / MSE / R² of a per-game prediction (line totals) vs the actual total."""
    p = load(spark, d, "lineitem").groupBy("l_orderkey").agg(
        (F.sum(F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))) / 1000).alias("pred"))
    o = load(spark, d, "orders")
    e = o.join(p, o.o_orderkey == p.l_orderkey, "left").select(
        (F.col("o_totalprice") / 1000).alias("y"), F.coalesce("pred", F.lit(0.0)).alias("pred"))
    return ST.regression_metrics(e, "y", "pred")


# ---------------------------------------------------------------- A7 / A8 / A9

@register("value_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, d):
    """Value counts with rename."""
    return A.value_counts(load(spark, d, "events"), "event_type", "event_type", "n")


PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("null_profile", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"COUNT(DISTINCT {c}) AS distinct_count FROM orders" for c in PROFILE_COLS))
def null_profile(spark, d):
    """NULL counts and distinct counts per column."""
    return A.null_profile(load(spark, d, "orders"), PROFILE_COLS)


DESCRIBE_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@register("describe_columns", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {R(f'AVG({c})', 4)} AS mean, {R(f'STDDEV_SAMP({c})', 4)} AS std, "
    f"CAST(MIN({c}) AS DOUBLE) AS min, {R(f'QUANTILE_CONT({c}, 0.25)', 4)} AS p25, {R(f'QUANTILE_CONT({c}, 0.5)', 4)} AS p50, "
    f"{R(f'QUANTILE_CONT({c}, 0.75)', 4)} AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM lineitem" for c in DESCRIBE_COLS))
def describe_columns(spark, d):
    """count/mean/std/min/quartiles/max, exact quartiles also for high-cardinality columns."""
    return A.describe_columns(load(spark, d, "lineitem"), DESCRIBE_COLS)


# ---------------------------------------------------------------- A16 / A17

@register("majority_vote", """
SELECT l.l_orderkey, COUNT(*) FILTER (WHERE l.l_quantity > p.p_size) AS home_wins,
       COUNT(*) FILTER (WHERE p.p_size > l.l_quantity) AS away_wins,
       COUNT(*) FILTER (WHERE l.l_quantity > p.p_size) > COUNT(*) FILTER (WHERE p.p_size > l.l_quantity) AS home_predicted_win
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY l.l_orderkey""")
def majority_vote(spark, d):
    """Per game, the side winning more simulated trials (trial = line; home
    runs = quantity, away runs = part size)."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = load(spark, d, "part").select("p_partkey", "p_size")
    trials = li.join(part, li.l_partkey == part.p_partkey)
    return A.majority_vote(trials, "l_orderkey", "l_quantity", "p_size")


TRANSITION_SQL = f"""
WITH seq AS (
  SELECT user_id, event_type AS event, value,
         COALESCE(LAG(event_type) OVER g, 'start') AS state,
         COALESCE(LEAD(event_type) OVER g, 'end') AS next_state
  FROM events
  WINDOW g AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)),
cnt AS (SELECT user_id, state, event, next_state, COUNT(*) AS n, AVG(value) AS avg_runs
        FROM seq GROUP BY user_id, state, event, next_state),
tot AS (SELECT user_id, state, COUNT(*) AS n_state FROM seq GROUP BY user_id, state)
SELECT c.user_id, c.state, c.event, c.next_state, c.n, {R('CAST(c.n AS DOUBLE) / t.n_state', 4)} AS prob,
       {R('c.avg_runs', 4)} AS avg_runs
FROM cnt c JOIN tot t ON t.user_id = c.user_id AND t.state = c.state"""


def play_sequence(spark, d):
    """Events in game order (game = player-day) with the previous and next
    event as states.  LAG/LEAD run as a skew-safe neighbour scan: a hot
    player-day is split over range partitions instead of one window task."""
    from diamondlake.operators.prefix import neighbours
    ev = load(spark, d, "events").select("user_id", F.to_date("ts").alias("game_date"), "ts", "event_id",
                                         "event_type", "value")
    seq = neighbours(ev, ["user_id", "game_date"], ["ts", "event_id"], "event_type", "__prev", "__next", bucket=F.date_trunc("hour", "ts"))
    return seq.select("user_id", "game_date", "ts", "event_id", F.col("event_type").alias("event"), "value",
                      F.coalesce("__prev", F.lit("start")).alias("state"),
                      F.coalesce("__next", F.lit("end")).alias("next_state"))


@register("transition_probs", TRANSITION_SQL)
def transition_probs(spark, d):
    """Empirical transition table P(event, next state | player, state), mean runs."""
    return A.transition_probs(play_sequence(spark, d), "user_id", "state", "event", "next_state", "value")


# ---------------------------------------------------------------- joins J1 J2 J5 J7 J8 J10

@register("join_star_inner", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_orderdate, c.c_name
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey""")
def join_star_inner(spark, d):
    """Fact → game → player inner chain with differently named keys."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, d, "customer").select("c_custkey", "c_name")
    out = J.join_chain(li, (o, li.l_orderkey == o.o_orderkey, "inner"), (c, o.o_custkey == c.c_custkey, "inner"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "c_name")


@register("join_star_left", """
SELECT e.event_id, e.user_id, c.c_name, n.n_name, r.r_name
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def join_star_left(spark, d):
    """LEFT JOIN chain of four tables; nation/region are bounded dims (broadcast)."""
    e = load(spark, d, "events").select("event_id", "user_id")
    c = load(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = J.broadcast_bounded(load(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    r = J.broadcast_bounded(load(spark, d, "region").select("r_regionkey", "r_name"))
    out = J.join_chain(e, (c, e.user_id == c.c_custkey, "left"), (n, c.c_nationkey == n.n_nationkey, "left"),
                       (r, n.n_regionkey == r.r_regionkey, "left"))
    return out.select("event_id", "user_id", "c_name", "n_name", "r_name")


LOADED_BEFORE = "1999-01-01"   # the warehouse already holds games before this date
FEED_FROM = "1998-01-01"       # the new feed re-delivers one overlapping season


@register("join_anti_normalized", f"""
WITH feed AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{FEED_FROM}'),
loaded AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_BEFORE}')
SELECT f.o_orderkey, f.o_custkey, f.o_orderpriority, f.o_orderdate, f.o_totalprice FROM feed f
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.o_custkey IS NOT DISTINCT FROM f.o_custkey
  AND lower(trim(l.o_orderpriority)) IS NOT DISTINCT FROM lower(trim(f.o_orderpriority))
  AND l.o_orderdate IS NOT DISTINCT FROM f.o_orderdate AND l.o_totalprice IS NOT DISTINCT FROM f.o_totalprice)""")
def join_anti_normalized(spark, d):
    """Feed rows whose normalised 4-part key is not loaded yet."""
    o = load(spark, d, "orders")
    feed = o.filter(F.col("o_orderdate") >= F.lit(FEED_FROM).cast("timestamp"))
    loaded = o.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp"))
    out = J.join_anti_normalized(feed, loaded, ["o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"],
                                 text_keys=["o_orderpriority"])
    return out.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")


@register("join_left_predictions", """
SELECT d.doc_id, d.source, d.lang, l.toxic AS predicted, l.quality AS actual
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def join_left_predictions(spark, d):
    """Schedule ⟕ predictions (documents ⟕ labels)."""
    docs = load(spark, d, "documents").select("doc_id", "source", "lang")
    lab = load(spark, d, "labels").select(F.col("doc_id").alias("l_doc_id"), F.col("toxic").alias("predicted"),
                                         F.col("quality").alias("actual"))
    return docs.join(lab, docs.doc_id == lab.l_doc_id, "left").drop("l_doc_id")


@register("join_semi", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""")
def join_semi(spark, d):
    """Membership of the game's team in a known set (left semi join)."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    known = load(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    return J.join_semi(o, known, "o_custkey", "c_custkey")


@register("join_double_anti", """
SELECT DISTINCT l_partkey AS player_id FROM lineitem
WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)
  AND l_partkey NOT IN (SELECT user_id FROM events)""")
def join_double_anti(spark, d):
    """Players in the pitch feed missing from the hitter dim and from the new hitters."""
    cand = load(spark, d, "lineitem").select(F.col("l_partkey").alias("player_id")).distinct()
    return J.join_double_anti(cand, load(spark, d, "customer"), load(spark, d, "events"), "player_id",
                              "c_custkey", "user_id")
