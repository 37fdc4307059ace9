"""Bronze → Silver cleaning: names, empty columns, duplicates, dates, medians, symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import try_date
from ..schemas import DEFAULT_SYMBOL, NON_METRIC_COLUMNS


# --- names and column selection -----------------------------------------------------------

def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """strip → lower → space to ``_``. camelCase is only lowercased. Collisions raise."""
    names = [normalize_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalisation: {dupes}")
    return df.toDF(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def metric_columns(df: DataFrame) -> list[str]:
    """Every column except the identifiers (symbol, date, currency, fiscal date)."""
    return [c for c in df.columns if c not in NON_METRIC_COLUMNS]


# --- profiles (one aggregate pass each) -----------------------------------------------------

def _null_counts_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count, row_count) for every column, from a single aggregate."""
    row = _null_counts_row(df)
    return row.unpivot(["__rows"], df.columns, "column_name", "null_count") \
              .select("column_name", F.col("null_count").cast("long"),
                      F.col("__rows").cast("long").alias("row_count"))


def null_profile(df: DataFrame, top: int = 5) -> DataFrame:
    """Columns with nulls: count and percentage (1 decimal), the ``top`` largest.

    Ties on the count are broken by column name so the cut is deterministic.
    """
    return (null_counts(df)
            .filter(F.col("null_count") > 0)
            .select("column_name", "null_count",
                    F.round(F.col("null_count") * 100.0 / F.col("row_count"), 1)
                    .alias("null_pct"))
            .orderBy(F.desc("null_count"), "column_name")
            .limit(top))


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("null_count").cast("long").alias("total_nulls"))


def profile(df: DataFrame, table: str | None = None) -> DataFrame:
    """(column_name, non_null_count, dtype) — the ``DataFrame.info`` table."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    prof = null_counts(df).select(
        "column_name", (F.col("row_count") - F.col("null_count")).alias("non_null_count"))
    dtype = F.create_map(*[x for n, t in types.items() for x in (F.lit(n), F.lit(t))])
    out = prof.withColumn("dtype", dtype[F.col("column_name")])
    if table is not None:
        out = out.withColumn("table_name", F.lit(table))
    return out


# --- row/column drops ----------------------------------------------------------------------

def empty_columns(df: DataFrame) -> list[str]:
    """Columns with no non-null value (one aggregate with a count per column)."""
    if not df.columns:
        return []
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    empty = set(empty_columns(df))
    return df.select(*[c for c in df.columns if c not in empty])


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (NULLs equal). Partial aggregation collapses hot copies map-side."""
    return df.dropDuplicates()


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


# --- dates ---------------------------------------------------------------------------------

def coerce_dates(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    """Parse ``column`` to DATE; unparseable text becomes NULL (``to_date`` would throw)."""
    if column not in df.columns:
        return df
    return df.withColumn(column, try_date(column, fmt))


def null_date_count(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).cast("long").alias("null_dates"))


def unify_statement_date(df: DataFrame) -> DataFrame:
    """``date`` from ``fiscaldateending``, else from ``date``, else NULL."""
    if "fiscaldateending" in df.columns:
        return df.withColumn("date", try_date("fiscaldateending"))
    if "date" in df.columns:
        return df.withColumn("date", try_date("date"))
    return df.withColumn("date", F.lit(None).cast("date"))


# --- medians and imputation ----------------------------------------------------------------

def column_medians(df: DataFrame, columns: list[str]) -> dict:
    """Exact median of each column (mean of the middle two on even counts).

    All (column, value) pairs are counted, range-sorted and read at the middle positions, so
    no task holds more than its range.
    """
    if not columns:
        return {}
    from .stats import exact_quantiles_long

    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns])))
    med = exact_quantiles_long(long, "column_name", "value", [0.5]).collect()
    return {**dict.fromkeys(columns), **{r["column_name"]: r["q"] for r in med}}


def _fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs of ``columns`` filled with their medians, as DOUBLE: the median of an even count of
    integers need not be one. Medians enter the plan as literals: a narrow projection."""
    med = column_medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c]))
                           for c in columns if med[c] is not None})


def impute_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill NULLs of every numeric column with that column's exact whole-table median."""
    cols = [c for c in (columns if columns is not None else numeric_columns(df)) if c in df.columns]
    if not cols:
        return df
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return _fill(df, [c for c in cols if nulls[c] > 0])


# --- symbol and validation -----------------------------------------------------------------

def ensure_symbol(df: DataFrame, default: str = DEFAULT_SYMBOL) -> DataFrame:
    if "symbol" in df.columns:
        return df
    if "ticker" in df.columns:
        return df.withColumn("symbol", F.col("ticker"))
    return df.withColumn("symbol", F.lit(default))


def validate_table(df: DataFrame, name: str, default_symbol: str = DEFAULT_SYMBOL) -> DataFrame:
    """Require ``date`` (raise otherwise), coerce it to DATE, ensure ``symbol``."""
    if "date" not in df.columns:
        raise ValueError(f"table {name!r}: no column named date to key it by")
    if not isinstance(df.schema["date"].dataType, T.DateType):
        df = df.withColumn("date", try_date("date"))
    return ensure_symbol(df, default_symbol)


# --- composed Silver steps -----------------------------------------------------------------

def preprocess_raw(df: DataFrame) -> DataFrame:
    """Extract-time light clean: normalise names, drop empty columns, drop duplicates."""
    return dedupe_rows(drop_empty_columns(normalize_columns(df)))


def clean_statement(raw: DataFrame, default_symbol: str = DEFAULT_SYMBOL) -> DataFrame:
    """Raw statement → Silver: names, empty columns, duplicates, date, median fill, symbol.

    Two actions in total: one profile aggregate (rows and non-null count per
    column, which finds both the empty columns and the columns to fill) and one
    for the medians. Duplicates are dropped before either, so medians see each
    row once; an all-NULL column does not change which rows are duplicates.
    """
    df = dedupe_rows(normalize_columns(raw))
    prof = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    df = df.drop(*[c for c in df.columns if prof[c] == 0])
    df = unify_statement_date(df)
    targets = [c for c in numeric_columns(df) if c in prof and 0 < prof[c] < prof["__rows"]]
    return ensure_symbol(_fill(df, targets) if targets else df, default_symbol)


def cleaning_report(raw: DataFrame, dataset: str) -> DataFrame:
    """Rows × columns before and after the light clean, with what was removed.

    One grouped pass: grouping the kept columns counts distinct rows (after) and
    summing the group sizes counts all rows (before); copies collapse map-side.
    """
    normalized = normalize_columns(raw)
    empty = empty_columns(normalized)
    kept = normalized.drop(*empty)
    groups = kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return (groups
            .agg(F.sum("__copies").cast("long").alias("rows_before"),
                 F.count(F.lit(1)).cast("long").alias("rows_after"))
            .select(F.lit(dataset).alias("dataset"), "rows_before",
                    F.lit(len(raw.columns)).alias("cols_before"), "rows_after",
                    F.lit(len(kept.columns)).alias("cols_after"),
                    (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"),
                    F.lit(len(empty)).alias("empty_columns_dropped")))
