import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from diamondlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="diamondlake-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from diamondlake.sources.tables import TABLES, table_path
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con
