"""Realised returns of signals on literal bars."""

import datetime as dt

from pyspark.sql import functions as F

from finmart.operators import trades

SCHEMA = "symbol string, date date, open double, close double, up boolean"


def _bars(spark, symbol, opens, ups):
    day = dt.date(2024, 1, 1)
    rows = [(symbol, day + dt.timedelta(days=i), o, o, u) for i, (o, u) in enumerate(zip(opens, ups))]
    return spark.createDataFrame(rows, SCHEMA)


def test_trades_enter_and_leave_at_the_next_open(spark):
    bars = _bars(spark, "A", [10.0, 20.0, 30.0, 15.0, 12.0, 10.0, 40.0], [True, True, False, None, True, False, True])
    held = trades.positions(bars, F.col("up"))
    out = trades.trades(held).orderBy("trade").collect()
    # bought at bar 1, sold at bar 3; bought at bar 5, sold at bar 6; the last bar's signal has no open
    assert [(r.trade, r.entry_price, r.exit_price, r.bars) for r in out] == [(1, 20.0, 15.0, 2), (2, 10.0, 40.0, 1)]
    assert [round(r.trade_return, 9) for r in out] == [-0.25, 3.0]
    got = trades.trade_statistics(held).first()
    assert (got.closed_trades, got.open_trades, got.bars, got.held_bars) == (2, 0, 7, 4)
    assert (got.win_rate, got.mean_return, got.profit_factor) == (0.5, 1.375, 12.0)
    daily = [r.held_return for r in held.orderBy("date").collect()]
    assert daily == [0.5, -0.5, 0.0, 0.0, 3.0, None, None]


def test_open_trades_flat_series_and_nulls(spark):
    bars = _bars(spark, "B", [10.0, 20.0, 30.0], [True, True, True]).unionByName(
        _bars(spark, "C", [10.0, 0.0, 30.0], [False, None, False])).unionByName(
        _bars(spark, "D", [10.0, 0.0, 30.0, 5.0], [True, False, False, False]))
    held = trades.positions(bars, F.col("up"))
    by = {r.symbol: r for r in trades.trade_statistics(held).collect()}
    assert (by["B"].closed_trades, by["B"].open_trades, by["B"].win_rate) == (0, 1, None)
    assert (by["C"].closed_trades, by["C"].open_trades, by["C"].sharpe) == (0, 0, None)
    assert (by["D"].open_trades, by["D"].profit_factor) == (1, None)       # entered at a price of zero
    none = trades.positions(bars.limit(0), F.col("up"))
    assert trades.trades(none).count() == trades.trade_statistics(none).count() == 0


def test_crossover_waits_for_full_frames(spark):
    bars = _bars(spark, "A", [float(i) for i in range(8)], [None] * 8)
    out = bars.select("date", trades.crossover(2, 4).alias("up")).orderBy("date").collect()
    assert [r.up for r in out] == [False] * 3 + [True] * 5
