"""Local stand-in for the driver's correctness gate: run each registered query
on Spark and its oracle SQL on DuckDB over the same parquet tables, compare
row count, column names and order-insensitive values.

usage: python check_oracle.py [--exact] [--types] [SF_DIR] [key ...]
(--exact: no float tolerance; --types: column types must correspond too)
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from diamondlake.plans.catalog import oracle_sql, queries
from diamondlake.session import build_session
from diamondlake.sources.tables import TABLES, table_path


EXACT = False


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
                 "BooleanType": "BOOLEAN", "FloatType": "FLOAT", "ShortType": "SMALLINT"}


def type_diffs(sdf, con, sql):
    """Column type differences between the Spark result and the oracle."""
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    out = []
    for f in sdf.schema.fields:
        st = SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString().upper())
        dt = duck.get(f.name)
        if dt is not None and st != dt:
            out.append(f"{f.name}: spark {st} / duck {dt}")
    return out


def compare(spark, con, sf_dir, key, fn, sql, check_types=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return dict(key=key, rows=len(spdf), status="rows-only", spark_s=round(t1 - t0, 2))
    if check_types:
        td = type_diffs(sdf, con, sql)
        if td:
            return dict(key=key, rows=len(spdf), status=f"TYPES {td}", spark_s=round(t1 - t0, 2))
    dpdf = con.execute(sql).df()
    sc, sr = _rows(spdf)
    dc, dr = _rows(dpdf)
    status = "ok"
    if sc != dc:
        status = f"COLS spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        status = f"ROWS spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        status = f"VALUES {bad}"
    return dict(key=key, rows=len(spdf), status=status, spark_s=round(t1 - t0, 2))


def main(argv):
    global EXACT
    if "--exact" in argv:
        EXACT = True
        argv = [a for a in argv if a != "--exact"]
    check_types = "--types" in argv
    argv = [a for a in argv if a != "--types"]
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")]
    spark = build_session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    qs, orc = queries(), oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        try:
            r = compare(spark, con, sf_dir, k, qs[k], orc.get(k), check_types)
        except Exception as e:  # noqa: BLE001
            r = dict(key=k, status=f"ERROR {type(e).__name__}: {str(e)[:300]}")
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} passed, {bad} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
