"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is a WITH chain over the driver tables that restates the Spark plan:
bars → price features, ledger → statements → Silver → star → marts/ML.
"""

from __future__ import annotations

from ..schemas import STOCK_METRICS

R_MONEY, R_STAT, R_ROLL, R_MEAN = 6, 7, 6, 4
SIG_COEF, SIG_PRICE = 9, 7


def sig(expr: str, digits: int = SIG_PRICE, alias: str | None = None) -> str:
    out = f"CAST(printf('%.{digits - 1}e', {expr}) AS DOUBLE)"
    return f"{out} AS {alias}" if alias else out
TICKER, OTHER_TICKER = "Supplier#000000001", "Supplier#000000002"
HORIZON = 30

W = "PARTITION BY symbol ORDER BY date ASC NULLS LAST"

BARS = """bars AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS close,
         count(*) AS volume, s_name AS symbol
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name, CAST(l_shipdate AS DATE))"""

TICK_BARS = """bars AS (
  SELECT CAST(ts AS DATE) AS date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, count(*) AS volume, event_type AS symbol
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""

FEATURES_SQL = f""",
pf0 AS (SELECT *, last_value(close IGNORE NULLS) OVER ({W}
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM bars),
pf1 AS (SELECT date, open, high, low, close, volume, symbol,
          ff / NULLIF(lag(ff) OVER ({W}), 0) - 1 AS pct_change,
          close - lag(close) OVER ({W}) AS daily_return FROM pf0),
prices AS (SELECT *,
  CASE WHEN count(pct_change) OVER w5 = 5 THEN stddev_samp(pct_change) OVER w5 END AS volatility_5d,
  CASE WHEN count(pct_change) OVER w20 = 20 THEN stddev_samp(pct_change) OVER w20 END
    AS volatility_20d
  FROM pf1
  WINDOW w5 AS ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w20 AS ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""
PRICES = BARS + FEATURES_SQL

PRICE_ROUND = {"open": R_MONEY, "high": R_MONEY, "low": R_MONEY, "close": R_MONEY,
               "pct_change": R_ROLL, "daily_return": R_MONEY,
               "volatility_5d": R_ROLL, "volatility_20d": R_ROLL}
PRICE_COLS = ["date", "open", "high", "low", "close", "volume", "symbol", "pct_change",
              "daily_return", "volatility_5d", "volatility_20d"]

LEDGER = """ledger AS (
  SELECT s_name AS symbol,
    CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) + INTERVAL 3 MONTH - INTERVAL 1 DAY
         AS DATE) AS quarter_end,
    CAST(sum(ep * (1 - disc)) AS DOUBLE) AS revenue,
    CAST(sum(qty * retail * 0.5) AS DOUBLE) AS cogs,
    CAST(sum(ep * disc) AS DOUBLE) AS opex,
    CAST(sum(CASE WHEN flag = 'R' AND disc >= 0.09 THEN ep END) AS DOUBLE) AS interest,
    CAST(sum(ep * tax) AS DOUBLE) AS tax,
    CAST(sum(ep * (1 - disc) - qty * retail * 0.5 - ep * disc - ep * tax) AS DOUBLE) AS net,
    CAST(sum(ep) AS DOUBLE) AS gross,
    CAST(sum(ep * (disc + tax) * 4) AS DOUBLE) AS liabilities,
    CAST(sum(CASE WHEN flag <> 'N' THEN qty END) AS DOUBLE) AS inventory,
    CAST(count(*) AS DOUBLE) AS lines,
    CAST(sum(ep * (1 - disc) + ep * (1 - disc) * tax - qty * retail * 0.5) AS DOUBLE) AS operating_cf,
    CAST(sum(qty * retail * 0.1) AS DOUBLE) AS capex,
    CAST(sum(CASE WHEN flag = 'A' THEN ep END) AS DOUBLE) AS receivables
  FROM (SELECT CAST(l_extendedprice AS DECIMAL(9,2)) AS ep,
               CAST(l_discount AS DECIMAL(3,2)) AS disc, CAST(l_tax AS DECIMAL(3,2)) AS tax,
               CAST(l_quantity AS DECIMAL(4,2)) AS qty,
               CAST(p_retailprice AS DECIMAL(7,2)) AS retail, l_returnflag AS flag,
               l_shipdate, s_name
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                      JOIN part ON l_partkey = p_partkey) j
  GROUP BY 1, 2)"""

HEADER = ("strftime(quarter_end, '%Y-%m-%d') AS fiscalDateEnding, "
          "'USD' AS reportedCurrency")

RAW = {
    "income_statement": f"""SELECT {HEADER}, revenue AS totalRevenue, cogs AS costOfRevenue,
    opex AS operatingExpenses,
    CASE WHEN year(quarter_end) >= 1997 THEN interest END AS interestExpense,
    tax AS incomeTaxExpense, CAST(NULL AS DOUBLE) AS depreciation, net AS netIncome, symbol
    FROM ledger""",
    "balance_sheet": f"""SELECT {HEADER}, gross AS totalAssets, liabilities AS totalLiabilities,
    CASE WHEN year(quarter_end) >= 1996 THEN inventory END AS inventory,
    lines * CAST(1000.0 AS DOUBLE) AS commonStock,
    CASE WHEN year(quarter_end) >= 2000 THEN CAST(-1000000.0 AS DOUBLE) END AS treasuryStock,
    CAST(NULL AS DOUBLE) AS investments, gross - liabilities AS totalShareholderEquity, symbol
    FROM ledger""",
    "cash_flow": f"""SELECT {HEADER}, operating_cf AS operatingCashflow,
    -capex AS cashflowFromInvestment, -tax AS cashflowFromFinancing,
    CASE WHEN quarter(quarter_end) = 4 THEN receivables * CAST(-0.01 AS DOUBLE) END
      AS changeInReceivables,
    CAST(NULL AS DOUBLE) AS dividendPayout, net AS netIncome, symbol
    FROM ledger""",
}
RAW_COLS = {
    "income_statement": ["fiscalDateEnding", "reportedCurrency", "totalRevenue", "costOfRevenue",
                         "operatingExpenses", "interestExpense", "incomeTaxExpense",
                         "depreciation", "netIncome", "symbol"],
    "balance_sheet": ["fiscalDateEnding", "reportedCurrency", "totalAssets", "totalLiabilities",
                      "inventory", "commonStock", "treasuryStock", "investments",
                      "totalShareholderEquity", "symbol"],
    "cash_flow": ["fiscalDateEnding", "reportedCurrency", "operatingCashflow",
                  "cashflowFromInvestment", "cashflowFromFinancing", "changeInReceivables",
                  "dividendPayout", "netIncome", "symbol"],
}
EMPTY = {"income_statement": ["depreciation"], "balance_sheet": ["investments"],
         "cash_flow": ["dividendPayout"]}
ABBR = {"balance_sheet": "bs", "income_statement": "inc", "cash_flow": "cf"}
ORDER = ["balance_sheet", "income_statement", "cash_flow"]
FIN_TYPE = {"balance_sheet": 1, "income_statement": 2, "cash_flow": 3}


def metrics(stmt: str) -> list[str]:
    return [c.lower() for c in RAW_COLS[stmt]
            if c not in EMPTY[stmt] and c.lower() not in
            ("symbol", "date", "reportedcurrency", "fiscaldateending")]


def silver_cols(stmt: str) -> list[str]:
    return [c.lower() for c in RAW_COLS[stmt] if c not in EMPTY[stmt]] + ["date"]


def statement_ctes(stmts=ORDER) -> str:
    parts = [LEDGER]
    for s in stmts:
        a = ABBR[s]
        kept = [c for c in RAW_COLS[s] if c not in EMPTY[s]]
        parts.append(f"{a}_raw AS ({RAW[s]})")
        parts.append(f"{a}_d AS (SELECT DISTINCT "
                     + ", ".join(f"{c} AS {c.lower()}" for c in kept) + f" FROM {a}_raw)")
        cols = []
        for c in kept:
            lc = c.lower()
            if lc in metrics(s):
                cols.append(f"coalesce({lc}, (SELECT median({lc}) FROM {a}_d)) AS {lc}")
            else:
                cols.append(lc)
        cols.append("TRY_CAST(fiscaldateending AS DATE) AS date")
        parts.append(f"{a}_s AS (SELECT {', '.join(cols)} FROM {a}_d)")
    return ",\n".join(parts)


def dim_sql() -> str:
    """dim_date, dim_company, dim_fin_metric, dim_stock_metric CTEs (needs prices + silver)."""
    union = " UNION ".join(["SELECT date FROM prices"] + [f"SELECT date FROM {ABBR[s]}_s"
                                                          for s in ORDER])
    app = " UNION ALL ".join(f"SELECT symbol, {i + 1} AS stmt_ord, date FROM {ABBR[s]}_s"
                             for i, s in enumerate(ORDER))
    seen, rows = set(), []
    for s in ORDER:
        for c in metrics(s):
            if c not in seen:
                seen.add(c)
                rows.append(f"({len(rows) + 1}, '{c}', '{s}', 'USD')")
    sm = ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(STOCK_METRICS))
    return f"""alld AS ({union}),
dim_date AS (SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
  CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
  monthname(date) AS month_name, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter,
  CAST(year(date) AS INTEGER) AS year, CAST(isodow(date) AS INTEGER) AS day_of_week,
  isodow(date) IN (6, 7) AS is_weekend FROM alld WHERE date IS NOT NULL),
app AS ({app}),
firsts AS (SELECT symbol, min(stmt_ord) AS s FROM app WHERE symbol IS NOT NULL GROUP BY symbol),
firstd AS (SELECT a.symbol, f.s, max(a.date) AS d FROM app a
           JOIN firsts f ON a.symbol = f.symbol AND a.stmt_ord = f.s GROUP BY a.symbol, f.s),
dim_company AS (SELECT CAST(row_number() OVER (ORDER BY s, d DESC NULLS LAST, symbol) AS INTEGER)
  AS company_key, symbol AS ticker, symbol AS company_name, 'Technology' AS industry,
  'NASDAQ' AS exchange FROM firstd),
dim_fin_metric AS (SELECT * FROM (VALUES {', '.join(rows)})
  AS t(metric_key, metric_name, metric_group, unit)),
dim_stock_metric AS (SELECT * FROM (VALUES {sm}) AS t(stock_metric_key, metric_name))"""


def fin_long_sql(stmt: str, a: str | None = None) -> str:
    a = a or ABBR[stmt]
    return " UNION ALL ".join(
        f"SELECT symbol, date, '{c}' AS metric_name, {i} AS col_ord, CAST({c} AS DOUBLE) AS value "
        f"FROM {a}_s WHERE {c} IS NOT NULL" for i, c in enumerate(metrics(stmt), start=1))


def price_long_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT symbol, date, '{m}' AS metric_name, {i} AS col_ord, "
        f"CAST({m} AS DOUBLE) AS value, {i} AS stock_metric_key FROM prices WHERE {m} IS NOT NULL"
        for i, m in enumerate(STOCK_METRICS, start=1))


def star_sql() -> str:
    fin = " UNION ALL ".join(
        f"SELECT *, {FIN_TYPE[s]} AS fin_type_key FROM ({fin_long_sql(s)})" for s in ORDER)
    return f"""{dim_sql()},
fin_long AS ({fin}),
fact_finance AS (SELECT CAST(row_number() OVER (ORDER BY l.fin_type_key, l.col_ord, l.date DESC,
    l.symbol) AS BIGINT) AS fact_finance_id, dd.date_key, c.company_key, l.fin_type_key,
    m.metric_key, l.value
  FROM fin_long l JOIN dim_company c ON l.symbol = c.ticker
  JOIN dim_fin_metric m ON l.metric_name = m.metric_name JOIN dim_date dd ON l.date = dd.date),
price_long AS ({price_long_sql()}),
fact_stock_prices AS (SELECT CAST(row_number() OVER (ORDER BY l.stock_metric_key, l.date,
    l.symbol) AS BIGINT) AS fact_price_id, dd.date_key, c.company_key, l.stock_metric_key,
    l.value
  FROM price_long l JOIN dim_company c ON l.symbol = c.ticker JOIN dim_date dd ON l.date = dd.date)"""


def with_all(body: str) -> str:
    return f"WITH {PRICES},\n{statement_ctes()},\n{star_sql()}\n{body}"


def with_prices(body: str) -> str:
    kw = "WITH RECURSIVE" if "fc(symbol" in body else "WITH"
    return f"{kw} {PRICES}\n{body}"


def with_statements(body: str, stmts=ORDER) -> str:
    return f"WITH {statement_ctes(stmts)}\n{body}"


def r(expr: str, digits: int, alias: str | None = None) -> str:
    return f"round({expr}, {digits}) AS {alias or expr}"


def price_select(prefix: str = "") -> str:
    return ", ".join(r(prefix + c, PRICE_ROUND[c], c) if c in PRICE_ROUND else prefix + c
                     for c in PRICE_COLS)


def silver_select(stmt: str) -> str:
    ms = set(metrics(stmt))
    return ", ".join(r(c, R_MONEY) if c in ms else c for c in silver_cols(stmt))


def raw_select(stmt: str, lower: bool = False, renames: dict | None = None,
               drop_empty: bool = False) -> str:
    out = []
    for c in RAW_COLS[stmt]:
        if drop_empty and c in EMPTY[stmt]:
            continue
        name = (renames or {}).get(c, c.lower() if lower else c)
        if c in ("fiscalDateEnding", "reportedCurrency", "symbol"):
            out.append(f"{c} AS {name}" if name != c else c)
        else:
            out.append(f"round({c}, {R_MONEY}) AS {name}")
    return ", ".join(out)


def quarter_ends(first_year: int = 1995, last_year: int = 2001) -> list[str]:
    ends = ["03-31", "06-30", "09-30", "12-31"]
    return [f"{y}-{e}" for y in range(first_year, last_year + 1) for e in ends]


# --- per-query SQL ---------------------------------------------------------------------------

def _long(ticker: str, stmt: str) -> str:
    return f"""stmt_long AS (SELECT f.*, dd.date, dd.day, dd.month, dd.month_name, dd.quarter,
    dd.year, dd.day_of_week, dd.is_weekend, m.metric_name, m.metric_group, m.unit
  FROM fact_finance f JOIN dim_date dd ON f.date_key = dd.date_key
  JOIN dim_fin_metric m ON f.metric_key = m.metric_key
  WHERE f.fin_type_key = {FIN_TYPE[stmt]}
    AND f.company_key IN (SELECT company_key FROM dim_company WHERE ticker = '{ticker}'))"""


def _wide(ticker: str = TICKER) -> str:
    piv = ", ".join(f"avg(CASE WHEN m.metric_name = '{mn}' THEN f.value END) AS {mn}"
                    for mn in STOCK_METRICS)
    return f"""wide AS (SELECT dd.date, {piv}, '{ticker}' AS symbol
  FROM fact_stock_prices f JOIN dim_date dd ON f.date_key = dd.date_key
  JOIN dim_stock_metric m ON f.stock_metric_key = m.stock_metric_key
  WHERE f.company_key IN (SELECT company_key FROM dim_company WHERE ticker = '{ticker}')
  GROUP BY dd.date)"""


def _training() -> str:
    return """training AS (SELECT * FROM (SELECT *, lead(pct_change) OVER (PARTITION BY symbol
    ORDER BY date ASC NULLS LAST) AS target FROM prices)
  WHERE date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
    AND close IS NOT NULL AND volume IS NOT NULL AND symbol IS NOT NULL
    AND pct_change IS NOT NULL AND daily_return IS NOT NULL AND volatility_5d IS NOT NULL
    AND volatility_20d IS NOT NULL AND target IS NOT NULL),
split AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date ASC NULLS LAST)
    <= floor(count(*) OVER (PARTITION BY symbol) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM training),
coef AS (SELECT symbol, CAST(printf('%.8e', regr_slope(target, pct_change)) AS DOUBLE) AS slope,
    CAST(printf('%.8e', regr_intercept(target, pct_change)) AS DOUBLE) AS intercept
  FROM split WHERE split = 'train' GROUP BY symbol),
pred AS (SELECT s.*, c.slope, c.intercept, c.intercept + c.slope * s.pct_change AS prediction
  FROM split s JOIN coef c ON s.symbol = c.symbol)"""


def _metrics(source: str, by: str) -> str:
    def agg(split: str) -> str:
        return f"""SELECT {by}, avg(abs(target - prediction)) AS mae,
    sqrt(avg((target - prediction) * (target - prediction))) AS rmse,
    1.0 - sum((target - prediction) * (target - prediction)) / NULLIF(var_pop(target) * count(*), 0)
      AS r2,
    avg(CASE WHEN sign(target) = sign(prediction) THEN 1.0 ELSE 0.0 END) * 100 AS da
  FROM {source} WHERE split = '{split}' GROUP BY {by}"""
    keys = [k.strip() for k in by.split(",")]
    on = " AND ".join(f"te.{k} = tr.{k}" for k in keys)
    sel = ", ".join(f"te.{k}" for k in keys)
    return f"""SELECT {sel}, te.mae, te.rmse, tr.r2 AS r2_train, te.r2 AS r2_test, te.da,
    te.rmse * 100 * 0.5 + (100.0 - te.da) * 0.5 AS score, tr.r2 - te.r2 AS gap
  FROM ({agg('test')}) te LEFT JOIN ({agg('train')}) tr ON {on}"""


METRIC_ROUND = {"mae": R_STAT, "rmse": R_STAT, "r2_train": R_STAT - 3, "r2_test": R_STAT - 3,
                "da": R_STAT, "score": R_STAT - 3, "gap": R_STAT - 3}


def _round_metrics(cols_before: str) -> str:
    return cols_before + ", " + ", ".join(r(c, d) for c, d in METRIC_ROUND.items())


def _context() -> str:
    return """ctx_r AS (SELECT *, row_number() OVER (PARTITION BY symbol
    ORDER BY date DESC NULLS LAST) AS rn FROM prices),
ctx AS (SELECT symbol,
    max(CASE WHEN rn = 1 THEN date END) AS date, max(CASE WHEN rn = 1 THEN open END) AS open,
    max(CASE WHEN rn = 1 THEN high END) AS high, max(CASE WHEN rn = 1 THEN low END) AS low,
    max(CASE WHEN rn = 1 THEN close END) AS close, max(CASE WHEN rn = 1 THEN volume END) AS volume,
    max(CASE WHEN rn = 1 THEN pct_change END) AS pct_change,
    max(CASE WHEN rn = 1 THEN daily_return END) AS daily_return,
    max(CASE WHEN rn = 1 THEN volatility_5d END) AS volatility_5d,
    max(CASE WHEN rn = 1 THEN volatility_20d END) AS volatility_20d,
    avg(CASE WHEN rn <= 5 THEN volatility_5d END) AS avg_volatility_5d,
    avg(CASE WHEN rn <= 20 THEN volatility_20d END) AS avg_volatility_20d,
    avg(CASE WHEN rn <= 5 THEN volume END) AS avg_volume,
    stddev_samp(pct_change) AS daily_volatility
  FROM ctx_r GROUP BY symbol)"""


def _forecast() -> str:
    return f"""{_training()},
{_context()},
fc_ctx AS (SELECT ctx.*, coef.slope, coef.intercept FROM ctx JOIN coef ON ctx.symbol = coef.symbol),
fc(symbol, step, date, close, pct_change) AS (
  SELECT symbol, 0, date, CAST(close AS DOUBLE), CAST(pct_change AS DOUBLE) FROM fc_ctx
  UNION ALL
  SELECT fc.symbol, fc.step + 1,
    CAST(fc.date + CASE isodow(fc.date + 1) WHEN 6 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS DATE),
    fc.close * (1.0 + (c.intercept + c.slope * fc.pct_change)),
    (fc.close * (1.0 + (c.intercept + c.slope * fc.pct_change)) - fc.close) / NULLIF(fc.close, 0)
  FROM fc JOIN fc_ctx c ON fc.symbol = c.symbol WHERE fc.step < {HORIZON}),
forecast AS (SELECT symbol, CAST(step AS INTEGER) AS step, date, close AS predicted_price
  FROM fc WHERE step > 0)"""


def _full(how: str, c: str, n: int) -> str:
    """An aggregate of the last n rows, NULL until n values are not null."""
    over = f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) {over} = {n} THEN {how}({c}) {over} END"


def _decayed(c: str, span: int) -> str:
    keep = 1 - 2 / (span + 1)
    weights = [keep ** k for k in range(span)]
    return " + ".join(f"lag({c}, {k}) OVER ({W}) * CAST('{weights[k] / sum(weights)!r}' AS DOUBLE)"
                      for k in range(span))


def _indicators() -> dict[str, str]:
    bars, lag = f"WITH {BARS}", f"OVER ({W})"
    q = {"moving_averages": f"""{bars} SELECT symbol, date, {r('close', R_MONEY)},
  round(close - lag(close) {lag}, {R_MONEY}) AS daily_return,
  round({_full('avg', 'close', 5)}, {R_MEAN}) AS ma_5, round({_full('avg', 'close', 20)}, {R_MEAN}) AS ma_20
FROM bars"""}
    q["oscillators"] = f"""{bars},
b1 AS (SELECT *, lag(close) {lag} AS prev FROM bars),
b2 AS (SELECT symbol, date, CASE WHEN prev IS NOT NULL THEN greatest(close - prev, 0.0) END AS up,
    CASE WHEN prev IS NOT NULL THEN greatest(prev - close, 0.0) END AS down,
    CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr,
    ({_decayed('close', 12)}) - ({_decayed('close', 26)}) AS macd FROM b1),
b3 AS (SELECT *, {_full('avg', 'up', 14)} AS u, {_full('avg', 'down', 14)} AS dn,
    {_full('avg', 'tr', 14)} AS atr, {_decayed('macd', 9)} AS macd_signal FROM b2)
SELECT symbol, date, round(u / NULLIF(u + dn, 0) * 100, {R_MEAN}) AS rsi, {r('atr', R_MEAN)},
  {r('macd', R_MEAN)}, {r('macd_signal', R_MEAN)} FROM b3"""
    q["price_bands"] = f"""{bars},
b1 AS (SELECT *, {_full('avg', 'close', 20)} AS m, {_full('stddev_pop', 'close', 20)} AS sd,
    {_full('min', 'low', 14)} AS lo, {_full('max', 'high', 14)} AS hi FROM bars),
b2 AS (SELECT *, (close - lo) / NULLIF(hi - lo, 0) * 100 AS stoch_k FROM b1)
SELECT symbol, date, {r('m', R_MEAN, 'middle')}, round(m + 2 * sd, {R_MEAN}) AS upper,
  round(m - 2 * sd, {R_MEAN}) AS lower, {r('stoch_k', R_MEAN)},
  round({_full('avg', 'stoch_k', 3)}, {R_MEAN}) AS stoch_d FROM b2"""
    q["candles"] = f"""{bars},
b1 AS (SELECT *, lag(open) {lag} AS o1, lag(close) {lag} AS c1, lag(close, 2) {lag} AS c2,
    lag(close, 3) {lag} AS c3, {_full('avg', 'volume', 5)} AS vm FROM bars)
SELECT symbol, date, CASE WHEN abs(close - open) <= (high - low) * CAST(0.1 AS DOUBLE) THEN 'doji'
    WHEN close > open THEN 'bullish' ELSE 'bearish' END AS candle,
  coalesce(c1 < o1 AND close > open AND open <= c1 AND close >= o1, false) AS bullish_engulfing,
  {r('c1', R_MONEY, 'close_lag_1')}, {r('c2', R_MONEY, 'close_lag_2')}, {r('c3', R_MONEY, 'close_lag_3')},
  {r('vm', R_MEAN, 'volume_ma_5')}, round(volume / NULLIF(vm, 0), {R_MEAN}) AS volume_ratio FROM b1"""
    lagged = ", ".join(f"round(lag({c}) {lag}, {PRICE_ROUND[c]}) AS {c}" for c in
                       ("pct_change", "daily_return", "volatility_5d", "volatility_20d"))
    held = f"""{bars},
sg AS (SELECT symbol, date, open, coalesce(round({_full('avg', 'close', 5)}, 6)
    > round({_full('avg', 'close', 20)}, 6), false) AS held FROM bars),
ps AS (SELECT symbol, date, held, coalesce(lag(held) {lag}, false) AS before, lead(date) {lag} AS next_date,
    lead(open) {lag} AS next_open, lead(open, 2) {lag} / NULLIF(lead(open) {lag}, 0) - 1 AS gain FROM sg),
nb AS (SELECT *, sum(CASE WHEN held AND NOT before THEN 1 ELSE 0 END) OVER ({W}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS trade FROM ps),
tr AS (SELECT symbol, CAST(trade AS INTEGER) AS trade, count(*) FILTER (WHERE held) AS bars,
    max(next_date) FILTER (WHERE held AND NOT before) AS entry_date,
    max(next_open) FILTER (WHERE held AND NOT before) AS entry_price,
    max(next_date) FILTER (WHERE before AND NOT held) AS exit_date,
    max(next_open) FILTER (WHERE before AND NOT held) AS exit_price FROM nb WHERE held OR before GROUP BY 1, 2),
td AS (SELECT *, exit_price / NULLIF(entry_price, 0) - 1 AS tret FROM tr WHERE entry_date IS NOT NULL)"""
    q["signal_trades"] = f"""{held}
SELECT symbol, trade, bars, entry_date, exit_date, {r('entry_price', R_MONEY)}, {r('exit_price', R_MONEY)},
  {r('tret', R_ROLL, 'trade_return')} FROM td"""
    q["signal_statistics"] = f"""{held},
pt AS (SELECT symbol, count(tret) AS closed, count(*) FILTER (WHERE tret IS NULL) AS still,
    avg(CASE WHEN tret > 0 THEN 1.0 WHEN tret <= 0 THEN 0.0 END) AS wins, avg(tret) AS mean,
    sum(tret) FILTER (WHERE tret > 0) / NULLIF(-sum(tret) FILTER (WHERE tret < 0), 0) AS factor FROM td GROUP BY 1),
pb AS (SELECT symbol, count(*) AS bars, count(*) FILTER (WHERE held) AS held_bars,
    avg(h) * sqrt(252) / NULLIF(stddev_samp(h), 0) AS sharpe
  FROM (SELECT symbol, held, CASE WHEN held THEN gain WHEN gain IS NOT NULL THEN 0 END AS h FROM ps) x GROUP BY 1)
SELECT symbol, bars, held_bars, {r('sharpe', R_ROLL)}, coalesce(closed, 0) AS closed_trades,
  coalesce(still, 0) AS open_trades, {r('wins', R_ROLL, 'win_rate')}, {r('mean', R_ROLL, 'mean_return')},
  {r('factor', R_ROLL, 'profit_factor')} FROM pb LEFT JOIN pt USING (symbol)"""
    q["guarded_features"] = with_prices(f"SELECT symbol, date, {lagged} FROM prices")
    q["walk_forward"] = with_prices(f""", {_training()},
wb AS (SELECT symbol, pct_change AS x, target AS y, least(floor((row_number() {lag} - 1) /
    greatest(floor(count(*) OVER (PARTITION BY symbol) / 5), 1)), 4) AS block FROM training),
wf AS (SELECT wb.*, f.fold FROM wb, (VALUES (1), (2), (3), (4)) AS f(fold) WHERE block <= fold),
wl AS (SELECT symbol, fold, regr_slope(y, x) FILTER (WHERE block < fold) AS slope,
    regr_intercept(y, x) FILTER (WHERE block < fold) AS intercept,
    count(*) FILTER (WHERE block < fold) AS train_rows FROM wf GROUP BY symbol, fold),
we AS (SELECT wf.symbol, wf.fold, train_rows, y - (intercept + slope * x) AS e
  FROM wf JOIN wl ON wf.symbol = wl.symbol AND wf.fold = wl.fold WHERE block >= wf.fold)
SELECT symbol, CAST(fold AS INTEGER) AS fold, train_rows, count(*) AS test_rows,
  round(avg(abs(e)), {R_ROLL}) AS mae, round(sqrt(avg(e * e)), {R_ROLL}) AS rmse
FROM we GROUP BY symbol, fold, train_rows""")
    return q


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    inc_cols = silver_cols("income_statement")
    q["price_features"] = with_prices(f"SELECT {price_select()} FROM prices")
    q["tick_bar_features"] = f"WITH {TICK_BARS}{FEATURES_SQL}\nSELECT {price_select()} FROM prices"
    wide_sel = ", ".join(r(c, PRICE_ROUND.get(c, R_MONEY)) for c in STOCK_METRICS)
    q["mart_prices_wide"] = with_all(f", {_wide()} SELECT date, {wide_sel}, symbol FROM wide")

    inc_only = ["income_statement"]
    q["raw_scan"] = with_statements(
        f"SELECT {raw_select('income_statement')} FROM inc_raw", inc_only)
    cells = " UNION ALL ".join(
        f"SELECT '{s}' AS table_name, symbol, date, metric_name, round(value, {R_ROLL}) AS value "
        f"FROM ({fin_long_sql(s)})" for s in ORDER)
    q["silver_roundtrip"] = (
        f"WITH {PRICES},\n{statement_ctes()} {cells} UNION ALL SELECT 'prices', symbol, date, "
        f"metric_name, round(value, {R_ROLL}) FROM ({price_long_sql()})")
    renames = {"fiscalDateEnding": "fiscal_date_ending", "reportedCurrency": "reported_currency",
               "totalRevenue": "total_revenue", "costOfRevenue": "cost_of_revenue"}
    q["normalize_columns"] = with_statements(
        f"SELECT {raw_select('income_statement', True, renames)} FROM inc_raw", inc_only)
    q["drop_empty_columns"] = with_statements(
        f"SELECT {raw_select('income_statement', True, drop_empty=True)} FROM inc_raw", inc_only)
    q["dedupe_rows"] = with_statements(
        f"SELECT DISTINCT {raw_select('income_statement')} FROM (SELECT * FROM inc_raw UNION ALL "
        f"SELECT * FROM inc_raw WHERE fiscalDateEnding LIKE '%-12-31')", inc_only)
    q["coerce_dates"] = """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'not a date'
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS order_date FROM orders"""
    bs_raw_cols = [c for c in RAW_COLS["balance_sheet"]]
    nulls = " UNION ALL ".join(
        f"SELECT '{c.lower()}' AS column_name, count(*) - count({c}) AS null_count, "
        f"count(*) AS row_count FROM bs_raw" for c in bs_raw_cols)
    q["null_profile"] = with_statements(
        f""", nc AS ({nulls})
SELECT column_name, CAST(null_count AS BIGINT) AS null_count,
  round(null_count * 100.0 / row_count, 1) AS null_pct FROM nc WHERE null_count > 0
ORDER BY null_count DESC, column_name LIMIT 5""", ["balance_sheet"])
    lines = "CASE WHEN month(date) <> 3 THEN CAST(commonstock / 1000 AS BIGINT) END"
    q["impute_median"] = with_statements(
        f""", bl AS (SELECT *, {lines} AS openlines FROM bs_s)
SELECT {silver_select('balance_sheet')}, round(CAST(coalesce(openlines, (SELECT median(openlines)
  FROM bl)) AS DOUBLE), {R_MONEY}) AS openlines FROM bl""", ["balance_sheet"])
    q["bad_dates"] = ("SELECT CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS null_dates "
                      "FROM orders")
    cf_cols = RAW_COLS["cash_flow"]
    q["total_nulls"] = with_statements(
        "SELECT CAST(" + " + ".join(f"count(*) - count({c})" for c in cf_cols)
        + " AS BIGINT) AS total_nulls FROM cf_raw", ["cash_flow"])
    q["statement_clean"] = with_statements(
        f"SELECT {silver_select('income_statement')} FROM inc_s", inc_only)
    q["validate_table"] = f"""WITH {BARS}
SELECT TRY_CAST(CASE WHEN dayofweek(date) = 0 THEN 'n/a' ELSE strftime(date, '%Y-%m-%d') END
  AS DATE) AS date, open, high, low, close, volume, 'GOOGL' AS symbol FROM bars"""
    reps = []
    for s in ORDER:
        a = ABBR[s]
        kept = [c for c in RAW_COLS[s] if c not in EMPTY[s]]
        reps.append(
            f"SELECT '{s}' AS dataset, CAST((SELECT count(*) FROM {a}_dup) AS BIGINT) AS rows_before, "
            f"{len(RAW_COLS[s])} AS cols_before, CAST((SELECT count(*) FROM (SELECT DISTINCT "
            f"{', '.join(kept)} FROM {a}_dup)) AS BIGINT) AS rows_after, {len(kept)} AS cols_after, "
            f"CAST((SELECT count(*) FROM {a}_dup) - (SELECT count(*) FROM (SELECT DISTINCT "
            f"{', '.join(kept)} FROM {a}_dup)) AS BIGINT) AS duplicates_removed, "
            f"{len(EMPTY[s])} AS empty_columns_dropped")
    dups = ", ".join(f"{ABBR[s]}_dup AS (SELECT * FROM {ABBR[s]}_raw UNION ALL SELECT * FROM "
                     f"{ABBR[s]}_raw WHERE fiscalDateEnding LIKE '%-12-31')" for s in ORDER)
    q["cleaning_report"] = with_statements(f", {dups} " + " UNION ALL ".join(reps))
    profs = []
    for s in ORDER:
        a = ABBR[s]
        for c in silver_cols(s):
            if c == "fiscaldateending":
                dtype = "date"
            elif c in ("reportedcurrency", "symbol"):
                dtype = "string"
            elif c == "date":
                dtype = "date"
            else:
                dtype = "double"
            profs.append(f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, "
                         f"'{dtype}' AS dtype, '{s}_cleaned_raw' AS table_name FROM {a}_s")
    q["profile_tables"] = with_statements(" UNION ALL ".join(profs))

    q["dim_date"] = with_all("SELECT * FROM dim_date")
    q["dim_company"] = with_all("SELECT * FROM dim_company")
    q["dim_fin_metric"] = with_all("SELECT * FROM dim_fin_metric")
    q["finance_unpivot"] = with_statements(
        f"SELECT symbol, date, metric_name, col_ord, round(value, {R_MONEY}) AS value FROM "
        f"({fin_long_sql('income_statement')})", inc_only)
    q["price_unpivot"] = with_prices(
        f"SELECT symbol, date, metric_name, col_ord, round(value, {R_ROLL}) AS value, "
        f"stock_metric_key FROM ({price_long_sql()})")
    q["star_fact_finance"] = with_all(
        f"SELECT fact_finance_id, date_key, company_key, fin_type_key, metric_key, "
        f"round(value, {R_MONEY}) AS value FROM fact_finance")
    q["star_fact_prices"] = with_all(
        f"SELECT fact_price_id, date_key, company_key, stock_metric_key, "
        f"round(value, {R_ROLL}) AS value FROM fact_stock_prices")
    q["seed_missing_rows"] = with_all("SELECT * FROM dim_date")
    q["gold_roundtrip"] = with_all(
        f"SELECT 'fact_finance' AS table_name, fact_finance_id AS row_id, date_key, company_key, "
        f"metric_key, round(value, {R_ROLL}) AS value FROM fact_finance WHERE date_key < 20000101 "
        f"UNION ALL SELECT 'fact_stock_prices', fact_price_id, date_key, company_key, "
        f"stock_metric_key, round(value, {R_ROLL}) FROM fact_stock_prices WHERE date_key < 20000101")
    pk = {"dim_date": "date_key", "dim_company": "company_key",
          "dim_fin_statement_type": None, "dim_fin_metric": "metric_key",
          "dim_stock_metric": "stock_metric_key", "fact_finance": "fact_finance_id",
          "fact_stock_prices": "fact_price_id", "lineitem": "l_orderkey, l_linenumber"}
    pk_parts = []
    for t, k in pk.items():
        if t == "dim_fin_statement_type":
            src, k = "(SELECT * FROM (VALUES (1), (2), (3)) AS v(fin_type_key))", "fin_type_key"
        else:
            src = t
        pk_parts.append(
            f"SELECT '{t}' AS table_name, '{k.replace(' ', '')}' AS key_columns, "
            f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys, "
            f"CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicates "
            f"FROM (SELECT count(*) AS n FROM {src} GROUP BY {k})")
    q["dq_primary_keys"] = with_all(" UNION ALL ".join(pk_parts))
    fks = [("fact_finance", "date_key", "dim_date_gap", "date_key"),
           ("fact_finance", "company_key", "dim_company", "company_key"),
           ("fact_finance", "fin_type_key", "dim_fin_statement_type", "fin_type_key"),
           ("fact_finance", "metric_key", "dim_fin_metric", "metric_key"),
           ("fact_stock_prices", "date_key", "dim_date_gap", "date_key"),
           ("fact_stock_prices", "company_key", "dim_company", "company_key"),
           ("fact_stock_prices", "stock_metric_key", "dim_stock_metric", "stock_metric_key")]
    fk_parts = []
    for child, cc, parent, pc in fks:
        psrc = ("(SELECT * FROM (VALUES (1), (2), (3)) AS v(fin_type_key))"
                if parent == "dim_fin_statement_type" else parent)
        fk_parts.append(
            f"SELECT '{child}' AS child_table, '{cc}' AS child_column, "
            f"'{parent.replace('_gap', '')}' AS parent_table, CAST(count(*) AS BIGINT) AS orphan_rows "
            f"FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {psrc} p WHERE p.{pc} = c.{cc})")
    q["dq_foreign_keys"] = with_all(
        ", dim_date_gap AS (SELECT * FROM dim_date WHERE NOT is_weekend) "
        + " UNION ALL ".join(fk_parts))
    counts = [("dim_date", "dim_date"), ("dim_company", "dim_company"),
              ("dim_fin_metric", "dim_fin_metric"),
              ("dim_fin_statement_type", "(SELECT 1 FROM (VALUES (1), (2), (3)) AS v(x))"),
              ("dim_stock_metric", "dim_stock_metric"), ("fact_finance", "fact_finance"),
              ("fact_stock_prices", "fact_stock_prices")]
    cparts = " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS row_count "
                                f"FROM {src}" for n, src in counts)
    q["table_counts"] = with_all(
        f", tc AS ({cparts}) SELECT * FROM tc UNION ALL "
        f"SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM tc")
    q["warehouse_refresh"] = q["table_counts"]

    q["mart_price_range"] = with_all(
        f", {_wide()} SELECT date, " + ", ".join(r(c, PRICE_ROUND.get(c, R_MONEY)) for c in
                                                 ["open", "high", "low", "close", "volume"])
        + " FROM wide WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
    long_cols = ("fact_finance_id, date_key, company_key, fin_type_key, metric_key, "
                 f"round(value, {R_MONEY}) AS value, date, day, month, month_name, quarter, year, "
                 "day_of_week, is_weekend, metric_name, metric_group, unit")
    q["mart_statement_long"] = with_all(
        f", {_long(OTHER_TICKER, 'income_statement')} SELECT {long_cols} FROM stmt_long")
    piv = ", ".join(f"round(first(value) FILTER (WHERE date = DATE '{dq}'), {R_MONEY}) AS \"{dq}\""
                    for dq in quarter_ends())
    q["mart_statement_matrix"] = with_all(
        f", {_long(TICKER, 'income_statement')} SELECT metric_name, {piv} FROM stmt_long "
        f"GROUP BY metric_name")
    q["metric_trend"] = with_all(
        f", {_long(TICKER, 'balance_sheet')} SELECT date, metric_name, round(value, {R_MONEY}) AS value "
        f"FROM stmt_long WHERE metric_name IN (SELECT metric_name FROM (SELECT DISTINCT "
        f"metric_key, metric_name FROM stmt_long ORDER BY metric_key LIMIT 2))")
    q["metric_choice"] = with_all(
        f", {_long(OTHER_TICKER, 'cash_flow')} SELECT date, metric_name, round(value, {R_MONEY}) AS value "
        f"FROM stmt_long WHERE metric_name IN ('netincome', 'operatingcashflow')")
    q["distinct_metrics"] = with_all(
        f", {_long(TICKER, 'cash_flow')} SELECT DISTINCT metric_name FROM stmt_long")
    q["date_bounds"] = with_prices(
        "SELECT symbol, min(date) AS min_date, max(date) AS max_date, count(*) AS row_count "
        "FROM prices GROUP BY symbol")
    q["latest_kpis"] = with_prices(
        f""", k AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close,
    max(date) OVER (PARTITION BY symbol) AS last_date FROM prices)
SELECT symbol, date, {r('close', R_MONEY)}, {r('open', R_MONEY)}, {r('high', R_MONEY)},
  {r('low', R_MONEY)}, {r('prev_close', R_MONEY)}, round(close - prev_close, {R_MONEY}) AS change,
  round((close - prev_close) / NULLIF(prev_close, 0) * 100.0, {R_STAT}) AS change_pct
FROM k WHERE date = last_date""")
    q["price_volume_series"] = with_prices("SELECT symbol, date, close, volume FROM prices")
    q["revenue_series"] = with_statements(
        f"SELECT symbol, date, round(totalrevenue, {R_MONEY}) AS totalrevenue FROM inc_s", inc_only)
    q["cashflow_series"] = with_statements(
        "SELECT symbol, date, " + ", ".join(
            r(c, R_MONEY) for c in ["operatingcashflow", "cashflowfrominvestment",
                                    "cashflowfromfinancing"]) + " FROM cf_s", ["cash_flow"])
    q["assets_series"] = with_statements(
        f"SELECT symbol, date, round(totalassets, {R_MONEY}) AS totalassets FROM bs_s",
        ["balance_sheet"])
    comps = [(c.lower(), c) for c in ("costOfRevenue", "operatingExpenses", "interestExpense")]
    avgs = ", ".join(f"avg({c}) AS a{i}" for i, (_, c) in enumerate(comps))
    total = " + ".join(f"a{i}" for i in range(len(comps)))
    rows = " UNION ALL ".join(
        f"SELECT '{label}' AS component, '{c.lower()}' AS column_name, round(a{i}, {R_MONEY}) "
        f"AS avg_value, round(a{i} / NULLIF(0.0 + {total}, 0) * 100, {R_STAT}) AS share_pct FROM av"
        for i, (label, c) in enumerate(comps))
    q["cost_structure"] = with_statements(f", av AS (SELECT {avgs} FROM inc_raw) {rows}", inc_only)
    bs_num = metrics("balance_sheet")
    pairs = []
    for i, a in enumerate(bs_num):
        for b in bs_num[i:]:
            expr = (f"covar_pop({a}, {b}) / NULLIF(stddev_pop(CASE WHEN {a} IS NOT NULL AND {b} IS "
                    f"NOT NULL THEN {a} END) * stddev_pop(CASE WHEN {a} IS NOT NULL AND {b} IS NOT "
                    f"NULL THEN {b} END), 0)")
            pairs.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({expr}, {R_STAT}) AS corr "
                         f"FROM bs_s")
            if a != b:
                pairs.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, round({expr}, {R_STAT}) "
                             f"AS corr FROM bs_s")
    q["correlation_matrix"] = with_statements(" UNION ALL ".join(pairs), ["balance_sheet"])

    t_round = price_select() + f", round(target, {R_ROLL}) AS target"
    q["training_frame"] = with_prices(f", {_training().split(',' + chr(10) + 'split AS')[0]} "
                                      f"SELECT {t_round} FROM training")
    q["train_test_split"] = with_prices(f", {_training()} SELECT {t_round}, split FROM split")
    q["price_reconstruction"] = with_prices(
        f", {_training()} SELECT symbol, date, round(close, {R_MONEY}) AS close, "
        f"{sig('close * (1 + prediction)', 10, 'predicted_price')}, "
        f"{sig('close * (1 + target)', 10, 'actual_price')} FROM pred WHERE split = 'test'")
    q["model_metrics"] = with_prices(
        f", {_training()}, mm AS ({_metrics('pred', 'symbol')}) "
        f"SELECT {_round_metrics('symbol')} FROM mm")
    q["model_ranking"] = with_prices(
        f""", {_training()},
cand AS (SELECT *, 'OLS pct_change' AS model, 1 AS model_ordinal FROM pred
  UNION ALL SELECT * REPLACE (0.0 AS prediction), 'Zero return' AS model, 2 AS model_ordinal
  FROM pred),
mm AS ({_metrics('cand', 'symbol, model, model_ordinal')})
SELECT {_round_metrics('symbol, model, model_ordinal')},
  CAST(row_number() OVER (PARTITION BY symbol ORDER BY score, model_ordinal) AS INTEGER) AS rank
FROM mm""")
    ctx_round = ", ".join(r(c, PRICE_ROUND[c]) if c in PRICE_ROUND else c for c in
                          ["open", "high", "low", "close", "volume", "pct_change", "daily_return",
                           "volatility_5d", "volatility_20d"])
    q["forecast_context"] = with_prices(
        f", {_context()} SELECT symbol, date, {ctx_round}, "
        + ", ".join(r(c, R_STAT) for c in ["avg_volatility_5d", "avg_volatility_20d",
                                           "avg_volume", "daily_volatility"]) + " FROM ctx")
    q["recursive_forecast"] = with_prices(
        f", {_forecast()} SELECT symbol, step, date, {sig('predicted_price', alias='predicted_price')} "
        f"FROM forecast")
    q["recommend_basic"] = with_prices(
        f""", {_forecast()},
rb AS (SELECT f.symbol, ctx.close AS current_price,
    arg_max(f.predicted_price, f.step) AS target_price, max(f.predicted_price) AS highest_price,
    min(f.predicted_price) AS lowest_price
  FROM forecast f JOIN ctx ON f.symbol = ctx.symbol GROUP BY f.symbol, ctx.close),
rc AS (SELECT *, (target_price - current_price) / NULLIF(current_price, 0) * 100.0 AS chg FROM rb)
SELECT symbol, {sig('current_price', alias='current_price')},
  {sig('target_price', alias='target_price')}, {sig('highest_price', alias='highest_price')},
  {sig('lowest_price', alias='lowest_price')}, {sig('chg', alias='change_percent')},
  CASE WHEN chg > 2.0 THEN 'UP_STRONG' WHEN chg > 0.5 THEN 'UP_SLIGHT'
       WHEN chg < -2.0 THEN 'DOWN_STRONG' WHEN chg < -0.5 THEN 'DOWN_SLIGHT' ELSE 'FLAT' END
    AS status,
  CASE WHEN chg > 2.0 THEN 'BUY' WHEN chg > 0.5 THEN 'CONSIDER_BUY'
       WHEN chg < -2.0 THEN 'SELL' WHEN chg < -0.5 THEN 'CAUTION' ELSE 'HOLD' END AS action
FROM rc""")
    q["ml_linear_fit"] = with_prices(
        f""", {_training()} SELECT count(*) AS n, {sig('regr_slope(target, pct_change)', 6, 'slope')},
  {sig('regr_intercept(target, pct_change)', 6, 'intercept')} FROM split WHERE split = 'train'""")
    q["split_series_features"] = q["price_features"]
    q.update(_indicators())
    q["split_moving_averages"] = q["moving_averages"]
    q["model_reload"] = with_prices(
        f", {_training()} SELECT split, count(*) AS n, 0 AS differing, CAST(0 AS DOUBLE) AS largest_difference "
        "FROM split GROUP BY split")
    q["malformed_rows"] = with_statements(" UNION ALL ".join(
        f"""SELECT '{s}' AS source, count(*) FILTER (WHERE m NOT IN ('06', '09')) AS good_rows,
  count(*) FILTER (WHERE m IN ('06', '09')) AS bad_rows,
  count(DISTINCT symbol) FILTER (WHERE m NOT IN ('06', '09')) AS symbols,
  max(fd) FILTER (WHERE m NOT IN ('06', '09')) AS last_quarter
  FROM (SELECT symbol, CAST(quarter_end AS VARCHAR) AS fd, substr(CAST(quarter_end AS VARCHAR), 6, 2) AS m FROM ledger)"""
        for s in ORDER))
    years = {t: "date_key // 10000" if t.startswith("fact") else "NULL" for t in GOLD_TABLES}
    q["return_quantiles"] = with_prices("SELECT symbol, strftime(date, '%Y-%m') AS month, " + ", ".join(
        r(f"quantile_cont(round(pct_change, {R_ROLL}), {p})", R_ROLL + 3, f"p{round(100 * p)}")
        for p in (0.05, 0.25, 0.5, 0.75, 0.95)) + " FROM prices WHERE pct_change IS NOT NULL GROUP BY 1, 2")
    q["wide_correlation"] = q["correlation_matrix"]
    q["reconcile_warehouse"] = with_all(", " + "rc AS (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({y} AS INTEGER) AS year FROM {FIXED_ROWS.get(t, t)}" for t, y in years.items())
        + ") SELECT table_name, year, count(*) AS gold_rows, count(*) AS warehouse_rows, true AS same "
          "FROM rc GROUP BY table_name, year")
    q["enforced_load"] = with_all(""", el AS (SELECT count(*) AS n FROM fact_finance)
SELECT '1 repeated' AS batch, CAST(0 AS BIGINT) AS rows_loaded, n AS rows_after FROM el
UNION ALL SELECT '2 orphans', 0, n FROM el UNION ALL SELECT '3 new', n, 2 * n FROM el""")
    q["direction_metrics"] = with_prices(f""", mv AS (SELECT symbol, date, pct_change AS move,
    {", ".join(f"lag({c}) OVER (PARTITION BY symbol ORDER BY date ASC NULLS LAST) AS f_{c}" for c in
               [c for c in PRICE_COLS if c not in ("date", "symbol")])}, close AS close_now FROM prices),
ok AS (SELECT date, move > 0 AS up, round(f_pct_change, {R_ROLL}) AS score FROM mv WHERE date IS NOT NULL
  AND symbol IS NOT NULL AND move IS NOT NULL AND close_now IS NOT NULL
  AND {" AND ".join(f"f_{c} IS NOT NULL" for c in PRICE_COLS if c not in ("date", "symbol"))}),
dd AS (SELECT date, count(*) AS n FROM ok GROUP BY date),
db AS (SELECT date, least(floor(coalesce(sum(n) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND
    1 PRECEDING), 0) * 4 / sum(n) OVER ()), 3) AS fold FROM dd),
sc AS (SELECT CAST(fold AS INTEGER) AS fold, up, score, score >= 0 AS said,
    rank() OVER (PARTITION BY fold ORDER BY score) AS low,
    count(*) OVER (PARTITION BY fold, score) AS ties FROM ok JOIN db USING (date) WHERE fold >= 1),
ag AS (SELECT fold, count(*) AS n, count(*) FILTER (WHERE up) AS p, count(*) FILTER (WHERE said) AS s,
    count(*) FILTER (WHERE up AND said) AS tp, count(*) FILTER (WHERE up = said) AS hit,
    sum(low + (ties - 1) / 2.0) FILTER (WHERE up) AS ranks FROM sc GROUP BY fold)
SELECT fold, n, p AS positives, round(hit / n, {R_STAT}) AS accuracy, round(tp / NULLIF(s, 0), {R_STAT}) AS precision,
  round(tp / NULLIF(p, 0), {R_STAT}) AS recall, round(2 * tp / NULLIF(p + s, 0), {R_STAT}) AS f1,
  round((ranks - p * (p + 1) / 2.0) / NULLIF(p * (n - p), 0), {R_STAT}) AS auc FROM ag""")
    return q


FIXED_ROWS = {"dim_fin_statement_type": "range(3)", "dim_stock_metric": f"range({len(STOCK_METRICS)})"}
GOLD_TABLES = ["dim_date", "dim_company", "dim_fin_statement_type", "dim_fin_metric", "dim_stock_metric",
               "fact_finance", "fact_stock_prices"]



ORACLE = _sql()
