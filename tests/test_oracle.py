"""Registered queries against their DuckDB SQL on the driver tables.

Every key runs on the smallest tables; FINMART_FULL_ORACLE=1 runs them at sf0.01. Mirrors the driver's check: row count, column names and an
order-insensitive hash of all values.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

from oracle_check import compare

SF = "/root/testdata/sf0.01" if os.environ.get("FINMART_FULL_ORACLE") else "/root/testdata/sf0.001"


def _keys():
    from finmart.plans.oracle import ORACLE
    return list(ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_queries_match_oracle(spark):
    res = compare(spark, SF, _keys(), verbose=True)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


def test_every_query_has_an_oracle_or_is_declared_non_sql():
    import __spark_entry__ as E
    from finmart.plans.queries import QUERIES
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == E.NO_ORACLE


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no smoke tables")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"date", "open", "close", "volume", "symbol"} <= set(df.columns)
