"""Declared tables: rules of single rows, keys, references, and rows set aside."""

from pyspark.sql import functions as F

from diamondlake.operators import constraints as C

TEAM = C.table(C.column("team", "string", key=True, length=3))
PLAYER = C.table(C.column("id", "bigint", key=True), C.column("name", "string", null=False, length=5), C.column("avg", "double", numeric=(4, 3)),
                 C.column("side", "string", values=["L", "R"]), C.column("team", "string", references=("team", "team")))
ROWS = [(1, "Ann", 0.3, "L", "OAK"), (2, None, 10.0, "X", "NYC"), (2, "Robert", 9.9996, None, None), (None, "Bo", float("nan"), "R", "OAK"), (5, "Cy", None, "R", "NYC")]


def tables(spark, rows=ROWS):
    return {"team": spark.createDataFrame([("OAK",)], "team string"), "player": spark.createDataFrame(rows, "id long, name string, avg double, side string, team string")}


def test_every_declared_rule_is_counted(spark):
    got = {(r["table"], r["rule"]): r["violations"] for r in C.check(tables(spark), {"team": TEAM, "player": PLAYER}).collect()}
    assert got == {
        ("team", "team not null"): 0, ("team", "team length 3"): 0, ("team", "team unique"): 0,
        ("player", "id not null"): 1, ("player", "name not null"): 1, ("player", "name length 5"): 1, ("player", "avg numeric 4,3"): 3,
        ("player", "side in values"): 1, ("player", "id unique"): 1, ("player", "team references"): 2}


def test_rows_are_set_aside_with_their_rules(spark):
    good, bad = C.split(tables(spark)["player"], PLAYER)
    assert good.columns == ["id", "name", "avg", "side", "team"]
    assert sorted(r["id"] for r in good.collect()) == [1, 5]
    assert {(r["id"], r["name"]): r["broken"] for r in bad.collect()} == {
        (2, None): "name not null, avg numeric 4,3, side in values", (2, "Robert"): "name length 5, avg numeric 4,3", (None, "Bo"): "id not null, avg numeric 4,3"}


def test_no_rows_and_no_rules(spark):
    empty = C.check(tables(spark, []), {"team": TEAM, "player": PLAYER}).agg(F.sum("violations")).first()[0]
    assert empty == 0
    good, bad = C.split(tables(spark)["player"], C.table(C.column("id", "bigint")))
    assert good.count() == 5 and bad.count() == 0


def test_violations_are_counted_while_writing(spark, tmp_path):
    df, seen = C.observed(tables(spark)["player"], PLAYER)
    df.write.parquet(str(tmp_path / "players"))
    assert seen.get["rows"] == 5 and seen.get["avg numeric 4,3"] == 3 and seen.get["id not null"] == 1


def test_row_rules_take_one_scan(spark, tmp_path):
    tables(spark)["player"].write.parquet(str(tmp_path / "p"))
    plan = C.violations(spark.read.parquet(str(tmp_path / "p")), PLAYER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan
