"""Registered plans against their DuckDB SQL on the smallest tables."""
import pytest

from tests.oracle_check import compare
from tests.conftest import SF_SMALL

def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert len(rows) > 0


def test_every_key_has_sql_or_is_rows_only():
    from lectern.plans.oracle import every_sql
    from lectern.plans.registry import PLANS
    assert set(PLANS) == set(every_sql())


def _keys():
    from lectern.plans.oracle import every_sql
    return sorted(every_sql())


@pytest.mark.parametrize("key", _keys())
def test_matches_duckdb(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=False)
    assert res[key][0] == "match", res[key]
