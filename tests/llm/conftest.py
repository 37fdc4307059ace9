import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from finmart.llm.common import ship  # noqa: E402

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_pdf():
    import duckdb
    return duckdb.sql(f"select * from '{SF}/documents.parquet' order by doc_id").df()


@pytest.fixture()
def sp(spark):
    ship(spark)
    return spark


@pytest.fixture()
def edge(sp):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rows = [(1, "a b c d e f g. The end!", None, None, None), (2, "a b c d e f g. The end!", "en", "s", 1),
            (3, None, None, None, None), (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 3),
            (6, "x" * 50_000, "en", "s", 5), (7, "wort " * 30_000, "de", "s", 9),
            (8, "A B C D E F G. the END!", "en", "s", 1), (9, "don't  stop\n\n 12 été  naïve 漢字 🙂", "fr", "s", 2),
            (9, "don't  stop\n\n 12 été  naïve 漢字 🙂", "fr", "s", 2), (None, "no id", "en", "s", 1)]
    base = sp.createDataFrame(rows, DOCS)
    return base.selectExpr("*", "1 as shard", "2.0 as score", "'k' as kept", "0 as bin", "'z' as digest",
                           "'q' as key", "3 as id", "4 as n", "5 as length", "'l' as locator")


@pytest.fixture()
def no_docs(sp):
    return sp.createDataFrame([], DOCS)
