"""The queries that SQL can express, side by side with DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare  # noqa: E402

from finmart.llm.oracle import ORACLE  # noqa: E402


@pytest.mark.parametrize("key", list(ORACLE))
def test_query_equals_its_sql(sp, key):
    assert compare(sp, "/root/testdata/sf0.001", [key])[key][0] == "OK"
