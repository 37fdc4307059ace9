"""Large stages are landed in passes: same rows, and little on disk beside what is landed."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from finmart import session
from finmart.operators import star
from finmart.operators.keys import date_slices
from finmart.plans import queries
from finmart.sources import files, fixtures

SF = "/root/testdata/sf0.001"


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if "shuffle" in found.apply(i).getName()}


def _bars(spark, days=30, symbols=6):
    rows = [(dt.date(2019, 12, 20) + dt.timedelta(d), float(s), None if (s + d) % 3 else 2.0, 0.5, 1.0 * d,
             10 * d, f"S{s}") for s in range(symbols) for d in range(days - s)]
    return spark.createDataFrame(rows, "date date, open double, high double, low double, close double, "
                                       "volume long, symbol string").repartition(5)


def test_a_stage_in_passes_has_the_same_rows_and_leaves_no_shuffle_files(spark):
    sums = _bars(spark).withColumn("symbol", F.when(F.col("symbol") != "S1", F.col("symbol"))) \
        .groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("close").alias("c"))
    before = _shuffle_files(spark)
    landed = session.materialize(sums, "sums", by="symbol", passes=4)
    for _ in range(100):   # files go in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert sorted(map(str, landed.collect())) == sorted(map(str, sums.collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_the_condition_of_a_pass_reaches_the_suppliers(spark):
    bars = fixtures.raw_prices(spark, SF, land=False)
    one = bars.filter(F.pmod(F.xxhash64("symbol"), F.lit(4)) == 1)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") > plan.index("Join")   # below the join, on the supplier's side


def test_date_slices_cover_every_date_once(spark):
    bars = _bars(spark)
    parts = [bars.filter(c) for c in date_slices(bars, 4)]
    assert len(parts) == 4 and sum(p.count() for p in parts) == bars.count()
    spans = [p.agg(F.min("date"), F.max("date")).first() for p in parts]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert max(p.count() for p in parts) < bars.count() / 2
    assert len(date_slices(bars.filter("date = '2019-12-20'"), 4)) == 1
    assert len(date_slices(bars.limit(0), 4)) == 1


def test_price_fact_keys_do_not_depend_on_the_passes(spark):
    bars = _bars(spark)
    companies = spark.createDataFrame([(i + 1, f"S{i}") for i in range(5)], "company_key int, ticker string")
    dates = star.dim_date(bars)
    once, sliced = (sorted(map(tuple, star.fact_stock_prices(bars, companies, dates, passes=n).collect()))
                    for n in (1, 4))
    assert once == sliced and [r[0] for r in once] == list(range(1, len(once) + 1))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["star_fact_prices", "silver_roundtrip"])
def test_queries_in_passes_give_the_same_rows_and_drop_their_stages(spark, monkeypatch, name):
    def run():
        start = len(session._made)
        df = queries.QUERIES[name](spark, SF)
        kept = [p for p in session._made[start:] if os.path.isdir(p.removeprefix("file:"))]
        return sorted(map(str, df.collect())), kept
    whole, _ = run()
    monkeypatch.setattr(fixtures, "LINES_A_PASS", 1500)
    assert fixtures.line_passes(spark, SF) > 2
    sliced, kept = run()
    assert sliced == whole
    if name == "star_fact_prices":   # bars and Silver prices went, the keyed rows stay
        bars = fixtures.raw_prices(spark, SF, land=False).count()
        counts = [spark.read.parquet(p).count() for p in kept]
        assert counts.count(bars) == 1


def test_a_dealt_version_is_written_without_a_sort_by_year(spark, tmp_path, monkeypatch):
    bars = _bars(spark)
    fact = star.fact_stock_prices(bars, spark.createDataFrame([(1, "S0")], "company_key int, ticker string"),
                                  star.dim_date(bars))
    before = spark.conf.get(files._OPEN_FILES)
    seen = []
    real = files._open_years
    monkeypatch.setattr(files, "_open_years", lambda s, n: seen.append(n) or real(s, n))
    spark.sql(f"CREATE DATABASE passes_wh LOCATION '{tmp_path}'")
    try:
        for dealt in (True, False):
            version = files._write_version(fact, "passes_wh.fact_stock_prices", "fact_stock_prices", dealt=dealt)
            got = spark.table(version).drop("year").collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, fact.collect()))
        assert seen == [files.OPEN_YEARS, 0] and spark.conf.get(files._OPEN_FILES) == before
    finally:
        spark.sql("DROP DATABASE passes_wh CASCADE")
