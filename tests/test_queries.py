"""Every registered query against its DuckDB twin (small scale factor)."""

import pytest

from oracle_check import compare
from tokenloom.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(e.queries()) and set(ORACLE) <= set(e.oracle_sql())


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, list(QUERIES))
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    assert not bad, bad
