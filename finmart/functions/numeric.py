"""Numeric expressions with the library's NULL-not-NaN and no-throw rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_change(new, old) -> Column:
    """``new / old - 1``; a zero or NULL divisor gives NULL instead of inf/error."""
    return F.try_divide(_c(new), _c(old)) - F.lit(1.0)


def percent_change(new, old) -> Column:
    """``(new - old) / old * 100`` with the same guard."""
    return F.try_divide(_c(new) - _c(old), _c(old)) * F.lit(100.0)


def same_sign(a, b) -> Column:
    """1.0 when both values have the same sign (0 only matches 0), else 0.0."""
    return (F.signum(_c(a)) == F.signum(_c(b))).cast("double")


def round_sig(c, digits: int) -> Column:
    """Round to ``digits`` significant digits (scientific text, parsed back to DOUBLE).

    Used where values span many magnitudes (compounded prices), so fixed decimal
    places would be either meaningless or too fine.
    """
    c = _c(c)
    text = F.format_string(f"%.{digits - 1}e", c)
    return F.when(c.isNull() | F.isnan(c), c).otherwise(text.cast("double"))
