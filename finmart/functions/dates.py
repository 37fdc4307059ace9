"""Date expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_date(c, fmt: str | None = None) -> Column:
    """Coerce text/timestamp to date; unparseable values become NULL (never throw)."""
    c = _c(c)
    return F.try_to_date(c.cast("string"), F.lit(fmt)) if fmt else F.try_to_date(c.cast("string"))


def date_key(c) -> Column:
    """yyyyMMdd integer key."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def month_name(c) -> Column:
    """Full English month name (``monthname`` would give the short form)."""
    return F.date_format(_c(c), "MMMM")


def quarter_label(c) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(c)).cast("string"))


def iso_weekday(c) -> Column:
    """ISO weekday, 1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(c)) + 1).cast("int")


def is_weekend(c) -> Column:
    return iso_weekday(c).isin(6, 7)


def next_business_day(c) -> Column:
    """The day after ``c``; a Saturday or Sunday rolls forward to Monday. No holidays."""
    c = _c(c)
    wd = F.weekday(F.date_add(c, 1))  # 0 = Monday
    step = F.when(wd == 5, 3).when(wd == 6, 2).otherwise(1)
    return F.date_add(c, step)


def quarter_end(c) -> Column:
    """Last calendar day of the quarter containing ``c``."""
    return F.date_add(F.add_months(F.trunc(_c(c).cast("date"), "quarter"), 3), -1)
