"""Keys of the facts come from the wide rows: same order, and nothing long is sorted or landed."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from finmart.operators import keys, quality, star
from finmart.sources import files


@pytest.fixture()
def landed(monkeypatch):
    rows = []
    real = keys.materialize

    def record(df, name="stage"):
        out = real(df, name)
        rows.append(out.count())
        return out
    monkeypatch.setattr(keys, "materialize", record)
    return rows


def _prices(spark, days=40, symbols=5):
    rows = []
    for s in range(symbols):
        for d in range(days):
            bare = (s + d) % 3 == 0
            rows.append((dt.date(2019, 12, 15) + dt.timedelta(d), float(d), None if bare else 1.0 * s,
                         float("nan") if d == 4 else 0.5, None, 10 * d, f"S{s}"))
    return spark.createDataFrame(rows, "date date, open double, high double, low double, close double, "
                                       "volume long, symbol string").repartition(7)


def _companies(spark):
    return spark.createDataFrame([(1, "S3"), (2, "S0"), (3, "S1")], "company_key int, ticker string")


def test_price_fact_keys_follow_metric_date_symbol(spark, landed):
    prices, companies = _prices(spark), _companies(spark)
    dates = star.dim_date(prices.filter("date < '2020-01-15'"))
    fact = star.fact_stock_prices(prices, companies, dates)
    got = {r.fact_price_id: tuple(r)[1:4] for r in fact.collect()}
    key = {r.ticker: r.company_key for r in companies.collect()}
    known = {r.date for r in dates.collect()}
    want = sorted((m, r.date, r.symbol) for r in prices.collect() if r.symbol in key and r.date in known
                  for m, c in enumerate(("open", "high", "low", "close", "volume"), start=1) if r[c] is not None)
    assert sorted(got) == list(range(1, len(want) + 1))
    assert [got[i + 1] for i in range(len(want))] == [
        (int(d.strftime("%Y%m%d")), key[s], m) for m, d, s in want]
    assert max(landed) <= prices.count()   # wide rows, not one a cell


def test_finance_fact_with_missing_and_repeated_metric_names(spark, landed):
    day = [dt.date(2020, 3, 31), dt.date(2020, 6, 30)]
    first = spark.createDataFrame([("S0", day[0], 1.0, None, 3.0), ("S0", day[1], 4.0, 5.0, 6.0),
                                   ("S1", day[1], 7.0, 8.0, None)],
                                  "symbol string, date date, a double, b double, c double")
    second = spark.createDataFrame([("S1", day[0], 9.0)], "symbol string, date date, b double")
    metrics = spark.createDataFrame([(5, "a", "g", "u"), (6, "b", "g", "u"), (7, "b", "g", "u")],
                                    "metric_key int, metric_name string, metric_group string, unit string")
    fact = star.fact_finance({"balance_sheet": first, "cash_flow": second}, _companies(spark), metrics,
                             star.dim_date(first))
    rows = [tuple(r) for r in fact.orderBy("fact_finance_id").collect()]
    assert [r[0] for r in rows] == list(range(1, 10))
    assert [(r[1], r[2], r[3], r[4]) for r in rows[:3]] == [
        (20200630, 2, 1, 5), (20200630, 3, 1, 5), (20200331, 2, 1, 5)]
    assert Counter((r[3], r[4], r[5]) for r in rows[3:]) == Counter(
        [(1, 6, 5.0), (1, 7, 5.0), (1, 6, 8.0), (1, 7, 8.0), (3, 6, 9.0), (3, 7, 9.0)])
    assert max(landed) <= 4


def test_keyed_fact_is_written_without_shuffling_long_rows(spark, tmp_path):
    prices = _prices(spark)
    fact = star.fact_stock_prices(prices, _companies(spark), star.dim_date(prices))
    files.write_gold(fact, "fact_stock_prices", str(tmp_path), dealt=True)
    back = files.read_gold(
        spark, str(tmp_path), ["fact_stock_prices"])["fact_stock_prices"]
    assert back.count() == fact.count()
    assert quality.primary_key_report({"fact_stock_prices": back}).first().duplicate_keys == 0
    assert sorted(p.name for p in (tmp_path / "facts" / "fact_stock_prices").iterdir()
                  if p.name.startswith("year=")) == ["year=2019", "year=2020"]
    assert back.agg(F.max("fact_price_id")).first()[0] == fact.count()
