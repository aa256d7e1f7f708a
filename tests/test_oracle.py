"""Every registered query vs its DuckDB oracle (sf0.001 for speed; the
sf0.01 gate is ``python check_oracle.py``)."""

import pytest

from check_oracle import compare
from diamondlake.plans.catalog import oracle_sql, queries
from tests.conftest import SF_SMALL

QS = queries()
ORACLE = oracle_sql()


@pytest.mark.parametrize("key", sorted(QS))
def test_query_matches_oracle(spark, duck, key):
    r = compare(spark, duck, SF_SMALL, key, QS[key], ORACLE.get(key), check_types=True)
    assert r["status"] in ("ok", "rows-only"), r


def test_oracle_keys_subset():
    assert set(ORACLE) <= set(QS)
