import importlib


def test_entry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["player", "tm", "pa"]
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 120
