"""Sources/sinks, warehouse tables, upserts, incremental loads and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from diamondlake.functions.scalars import round_half_up, round_half_up_sql as R
from diamondlake.operators import constraints as C
from diamondlake.operators import pruned_merge as PM
from diamondlake.operators import quality as Q
from diamondlake.operators import upsert as U
from diamondlake.plans import standins as S
from diamondlake.plans.catalog import register
from diamondlake.sources import files as IO
from diamondlake.sources.tables import load

SPLIT = "1999-01-01"      # warehouse holds games before this date
FEED = "1998-01-01"       # the new feed re-delivers from this date on


@register("scan_csv", "SELECT * FROM events")
def scan_csv(spark, d):
    """CSV scan with an explicit schema (the landed file is the events feed)."""
    ev = load(spark, d, "events")
    path = IO.write_csv(ev, IO.shared_path(spark, "events-csv"))
    return IO.scan_csv(spark, path, ev.schema)


@register("sink_csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def sink_csv_roundtrip(spark, d):
    """Write CSV with header (no index), read it back unchanged."""
    o = load(spark, d, "orders")
    path = IO.write_csv(o, IO.shared_path(spark, "orders-csv"))
    return IO.scan_csv(spark, path, o.schema)


@register("scan_project_filter", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def scan_project_filter(spark, d):
    """S3: projection + predicate scan.  Against a database this is
    ``read_jdbc(query=...)``; over Parquet the same plan pushes both down."""
    o = load(spark, d, "orders")
    return o.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@register("warehouse_roundtrip", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS season
FROM orders""")
def warehouse_roundtrip(spark, d):
    """Season-partitioned Parquet table, read back with all its seasons."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                        F.year("o_orderdate").alias("season"))
    path = IO.write_warehouse(o, IO.shared_path(spark, "games"), ["season"])
    return spark.read.parquet(path).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.col("season").cast("int").alias("season"))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("sink_append", f"SELECT {', '.join(ORDER_COLS)} FROM orders")
def sink_append(spark, d):
    """Append two disjoint batches in the table's column order."""
    o = load(spark, d, "orders")
    path = IO.shared_path(spark, "orders-append")
    first = o.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp"))
    second = o.filter(F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp"))
    IO.append_rows(first, path, ORDER_COLS)
    IO.append_rows(second.select(*reversed(ORDER_COLS)), path, ORDER_COLS)
    return spark.read.parquet(path)


def _customer_snapshots(spark, d):
    """Target: players seen before the split; batch: players seen since, with
    balance updated by their later spend and a segment that only new players take over."""
    o = load(spark, d, "orders")
    cust = load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    before = o.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp")).select(F.col("o_custkey").alias("c_custkey"))
    since = o.filter(F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp")).groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("spend"))
    target = cust.join(before, "c_custkey", "left_semi")
    batch = cust.join(since, "c_custkey").select(
        "c_custkey", F.upper("c_name").alias("c_name"),
        round_half_up(F.col("c_acctbal") + F.col("spend") / 1000, 2).alias("c_acctbal"),
        F.lower("c_mktsegment").alias("c_mktsegment"))
    return target, batch


UPSERT_SQL = f"""
WITH target AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
                WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}')),
since AS (SELECT o_custkey, SUM(o_totalprice) AS spend FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT}' GROUP BY o_custkey),
batch AS (SELECT c.c_custkey, upper(c.c_name) AS c_name, {R('c.c_acctbal + s.spend / 1000', 2)} AS c_acctbal,
                 lower(c.c_mktsegment) AS seg
          FROM customer c JOIN since s ON s.o_custkey = c.c_custkey)
SELECT t.c_custkey, t.c_name, t.c_acctbal, t.c_mktsegment FROM target t
WHERE t.c_custkey NOT IN (SELECT c_custkey FROM batch)
UNION ALL
SELECT b.c_custkey, b.c_name, b.c_acctbal, CASE WHEN t.c_custkey IS NULL THEN b.seg ELSE t.c_mktsegment END FROM batch b LEFT JOIN target t ON t.c_custkey = b.c_custkey"""


@register("upsert_by_key", UPSERT_SQL)
def upsert_by_key(spark, d):
    """Upsert a batch into a dimension: overwrite name and balance, keep segment."""
    target, batch = _customer_snapshots(spark, d)
    return U.upsert_by_key(target, batch, ["c_custkey"], ["c_name", "c_acctbal"])


@register("upsert_pruned", UPSERT_SQL)
def upsert_pruned(spark, d):
    """The same upsert into a table of files clustered by key, rewriting only files that hold a key of the batch."""
    target, batch = _customer_snapshots(spark, d)
    path = IO.shared_path(spark, "customer-table")
    PM.create(target, path, ["c_custkey"])
    batch = IO.cut_lineage_to(batch, IO.shared_path(spark, "customer-batch"))
    PM.merge(spark, path, batch, ["c_custkey"], ["c_name", "c_acctbal"])
    return PM.read(spark, path)


@register("incremental_append", f"SELECT {', '.join(ORDER_COLS)} FROM orders")
def incremental_append(spark, d):
    """Append only new keys; running the same batch twice changes nothing."""
    o = load(spark, d, "orders").select(*ORDER_COLS)
    path = IO.shared_path(spark, "orders-incremental")
    o.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp")).write.parquet(path)
    batch = o.filter(F.col("o_orderdate") >= F.lit(FEED).cast("timestamp"))
    for _ in range(2):  # the re-run must be a no-op
        # materialise the new rows before appending to the table they were computed from
        new = IO.cut_lineage_to(U.incremental_append(spark.read.parquet(path), batch, ["o_orderkey"]),
                                IO.shared_path(spark, "orders-batch"))
        IO.append_rows(new, path, ORDER_COLS)
    return spark.read.parquet(path)


@register("pending_dates", """
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) + INTERVAL 21 DAY AS s, CAST(MAX(o_orderdate) AS DATE) AS e FROM orders),
cal AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS game_date FROM b)
SELECT game_date FROM cal WHERE game_date < current_date
  AND game_date NOT IN (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')""")
def pending_dates(spark, d):
    """Days from opening day + 3 weeks up to the last game (and before
    today) with no final (status F) game loaded yet."""
    o = load(spark, d, "orders").agg(F.date_add(F.to_date(F.min("o_orderdate")), 21).alias("s"),
                                     F.to_date(F.max("o_orderdate")).alias("e"))
    cal = IO.calendar_spine(spark, o, "s", "e")
    loaded = load(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.to_date("o_orderdate").alias("game_date"))
    return U.pending_dates(cal, loaded, "game_date")


@register("calendar_spine", """
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS s, CAST(MAX(o_orderdate) AS DATE) AS e FROM orders)
SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS game_date FROM b""")
def calendar_spine(spark, d):
    """One row per day of the schedule span, past days only."""
    o = load(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    return IO.calendar_spine(spark, o, "s", "e")


@register("season_slice", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def season_slice(spark, d):
    """One season's slice; a range that spans two seasons is rejected."""
    return IO.season_slice(load(spark, d, "orders"), "o_orderdate", "1998-01-01", "1998-12-31").select(
        "o_orderkey", "o_orderdate")


# ---------------------------------------------------------------- data quality

@register("dq_unique", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def dq_unique(spark, d):
    """Primary-key violations of (game, at bat)."""
    return Q.dq_unique(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_foreign_key", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT c_custkey FROM customer)""")
def dq_foreign_key(spark, d):
    """Pitch rows whose batter id has no hitter-dim row."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return Q.dq_foreign_key(li, "l_partkey", load(spark, d, "customer"), "c_custkey")


NN_COLS = ["game_pk", "home_team", "away_team", "home_score", "away_score"]


@register("dq_not_null", f"WITH {S.GAMES_SQL.strip()}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM games" for c in NN_COLS))
def dq_not_null(spark, d):
    """D3: NOT NULL violations per column of the game table."""
    return Q.dq_not_null(S.games_df(spark, d), NN_COLS)


@register("dq_domain", """
SELECT 'c_name_varchar18' AS rule, COUNT(*) FILTER (WHERE length(c_name) > 18) AS violations FROM customer
UNION ALL SELECT 'c_acctbal_numeric6_2', COUNT(*) FILTER (WHERE abs(c_acctbal) >= 10000) FROM customer
UNION ALL SELECT 'c_mktsegment_varchar8', COUNT(*) FILTER (WHERE length(c_mktsegment) > 8) FROM customer""")
def dq_domain(spark, d):
    """VARCHAR length and NUMERIC(p, s) overflow checks."""
    return Q.dq_domain(load(spark, d, "customer"), {
        "c_name_varchar18": Q.varchar_overflow("c_name", 18),
        "c_acctbal_numeric6_2": Q.numeric_overflow("c_acctbal", 6, 2),
        "c_mktsegment_varchar8": Q.varchar_overflow("c_mktsegment", 8)})


# The warehouse's tables as declared: keys, references, lengths, precisions and allowed values.
SCHEMAS = {
    "game": C.table(C.column("game_pk", "bigint", key=True), C.column("game_date", "date", null=False), C.column("game_year", "int", null=False),
                    C.column("home_team", "bigint", null=False), C.column("away_team", "bigint", null=False),
                    C.column("home_score", "bigint", null=False, numeric=(1, 0)), C.column("away_score", "bigint", null=False)),
    "hitter": C.table(C.column("c_custkey", "bigint", key=True), C.column("c_name", "string", null=False, length=18), C.column("c_acctbal", "double", numeric=(5, 2)),
                      C.column("c_mktsegment", "string", null=False, length=9, values=["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"])),
    "pitch": C.table(C.column("l_orderkey", "bigint", key=True, references=("game", "game_pk")), C.column("l_linenumber", "int", key=True),
                     C.column("l_partkey", "bigint", null=False, references=("hitter", "c_custkey")), C.column("l_quantity", "double", numeric=(3, 1)),
                     C.column("l_discount", "double", numeric=(3, 3)), C.column("l_returnflag", "string", null=False, length=1, values=["R", "A"])),
}


def _declared_tables(spark, d):
    return {"game": S.games_df(spark, d), "hitter": load(spark, d, "customer"), "pitch": load(spark, d, "lineitem")}


def _count_sql(table: str, source: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{table}' AS \"table\", '{rule}' AS rule, COUNT(*) FILTER (WHERE {bad}) AS violations FROM {source}" for rule, bad in rules.items())


HITTER_RULES = {
    "c_custkey not null": "c_custkey IS NULL", "c_name not null": "c_name IS NULL", "c_name length 18": "length(c_name) > 18", "c_acctbal numeric 5,2": "abs(c_acctbal) >= 999.995",
    "c_mktsegment not null": "c_mktsegment IS NULL", "c_mktsegment length 9": "length(c_mktsegment) > 9",
    "c_mktsegment in values": "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"}
PITCH_RULES = {
    "l_orderkey not null": "l_orderkey IS NULL", "l_linenumber not null": "l_linenumber IS NULL", "l_partkey not null": "l_partkey IS NULL",
    "l_quantity numeric 3,1": "abs(l_quantity) >= 99.95", "l_discount numeric 3,3": "abs(l_discount) >= 0.9995", "l_returnflag not null": "l_returnflag IS NULL",
    "l_returnflag length 1": "length(l_returnflag) > 1", "l_returnflag in values": "l_returnflag NOT IN ('R', 'A')"}
GAME_RULES = {
    "game_pk not null": "game_pk IS NULL", "game_date not null": "game_date IS NULL", "game_year not null": "game_year IS NULL", "home_team not null": "home_team IS NULL",
    "away_team not null": "away_team IS NULL",
    "home_score not null": "home_score IS NULL", "home_score numeric 1,0": "home_score >= 10", "away_score not null": "away_score IS NULL"}


@register("dq_declared", f"WITH {S.GAMES_SQL.strip()}\n" + "\nUNION ALL ".join([
    _count_sql("game", "games", GAME_RULES), _count_sql("hitter", "customer", HITTER_RULES), _count_sql("pitch", "lineitem", PITCH_RULES),
    "SELECT 'game', 'game_pk unique', COUNT(*) FROM (SELECT game_pk FROM games GROUP BY 1 HAVING COUNT(*) > 1)",
    "SELECT 'hitter', 'c_custkey unique', COUNT(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING COUNT(*) > 1)",
    "SELECT 'pitch', 'l_orderkey+l_linenumber unique', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)",
    "SELECT 'pitch', 'l_orderkey references', COUNT(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT game_pk FROM games)",
    "SELECT 'pitch', 'l_partkey references', COUNT(*) FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT c_custkey FROM customer)"]))
def dq_declared(spark, d):
    """D1-D4 derived from the declared tables: every rule with its violations."""
    return C.check(_declared_tables(spark, d), SCHEMAS)


_BROKEN_SQL = ", ".join(f"CASE WHEN {bad} THEN '{rule}' END" for rule, bad in HITTER_RULES.items())


@register("dq_quarantine", f"""
SELECT * FROM (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, concat_ws(', ', {_BROKEN_SQL}) AS broken FROM customer) t WHERE broken <> ''""")
def dq_quarantine(spark, d):
    """D3/D4 at load time: rows set aside, each with the rules that it breaks."""
    rows = load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return C.split(rows, SCHEMAS["hitter"])[1]
