"""Bronze → Silver → Gold as one lazily planned job per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features, series, star
from ..schemas import DEFAULT_SYMBOL, STATEMENT_ORDER
from ..session import materialize


def silver_prices(raw_prices: DataFrame, default_symbol: str = DEFAULT_SYMBOL,
                  land: bool = False, series_rows: int | None = None, passes: int = 1) -> DataFrame:
    """Light clean, date coercion, per-symbol return/volatility features, symbol.

    With ``series_rows``, series of more rows than that are windowed in pieces (the cleaned bars
    are landed to count them).

    ``land`` checkpoints the result: the Silver → Gold stage boundary, so the
    several Gold tables built from it do not each recompute the windows; with ``passes``
    so many slices of the symbols are windowed one after the other.
    """
    df = clean.preprocess_raw(raw_prices)
    df = clean.coerce_dates(df, "date")
    df = clean.ensure_symbol(df, default_symbol)
    if series_rows and "close" in df.columns:
        df = materialize(df, "bars")
    if series_rows and "close" in df.columns and series.longest(df) > series_rows:
        df = features.add_price_features_in_pieces(df, series_rows)
    else:
        df = features.add_price_features(df)
    return materialize(df, by="symbol", passes=passes) if land else df


def silver_statements(raw: dict[str, DataFrame],
                      default_symbol: str = DEFAULT_SYMBOL,
                      land: bool = False) -> dict[str, DataFrame]:
    """Cleaned statements, each cleaned on first use (cleaning runs data-dependent
    profile passes, so statements nobody reads are never profiled); ``land``
    checkpoints each one at the Silver → Gold boundary."""
    from ..operators.star import LazyTables

    def builder(name):
        def build():
            df = clean.clean_statement(raw[name], default_symbol)
            return materialize(df) if land else df
        return build
    return LazyTables({name: builder(name) for name in STATEMENT_ORDER if name in raw})


def silver_layer(raw: dict[str, DataFrame],
                 default_symbol: str = DEFAULT_SYMBOL) -> dict[str, DataFrame]:
    out = dict(silver_statements(raw, default_symbol).items())
    if "prices" in raw:
        out["prices"] = silver_prices(raw["prices"], default_symbol, series_rows=features.SERIES_ROWS)
    return out


def gold_layer(spark: SparkSession, silver: dict[str, DataFrame],
               prices: DataFrame | None = None, land: bool = False, passes: int = 1,
               release_prices: bool = False) -> dict[str, DataFrame]:
    statements = {n: silver[n] for n in STATEMENT_ORDER if n in silver}
    return star.build_star(spark, prices if prices is not None else silver.get("prices"),
                           statements, land, passes, release_prices)


def run_etl(spark: SparkSession, raw: dict[str, DataFrame], silver_path: str | None = None,
            gold_path: str | None = None, warehouse_db: str | None = None) -> dict[str, DataFrame]:
    """Clean, model and (optionally) persist every layer; returns the Gold tables.

    Silver is written and re-read before Gold is built, as the layers are
    separate stages; Gold goes to dims/ and facts/ folders and, when a database
    is named, to catalog tables by full overwrite.
    """
    from ..sources import files

    silver = silver_layer(raw)
    if silver_path:
        files.write_silver(silver, silver_path)
        silver = files.read_silver(spark, silver_path, list(silver))
    gold = gold_layer(spark, silver)
    for name in ("dim_date", "dim_company"):   # built first: an empty one stops the run here
        gold[name]
    if gold_path:
        for name, df in gold.items():
            files.write_gold(df, name, gold_path, dealt=True)
        gold = files.read_gold(spark, gold_path)
    if warehouse_db:
        from ..session import scratch_path
        location = f"{gold_path.rstrip('/')}/warehouse" if gold_path else scratch_path(spark, "wh")
        files.create_star_tables(spark, warehouse_db, location)
        for name, df in gold.items():
            files.refresh_table(spark, df, f"{warehouse_db}.{name}", name)
    return gold
