"""Null-safe arithmetic and rounding that match pandas semantics on NULL.

* Division never throws (Spark 4 is ANSI): ``x / 0`` → NULL, like
  ``x / nullif(y, 0)`` in SQL; pandas' inf/NaN are later mapped to NULL.
* Rounding is half-even (``bround``), which is what pandas ``round`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sdiv(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (never raises)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def r(c, places: int = 2) -> Column:
    """Half-even rounding, as pandas does."""
    return F.bround(col_(c), places)


def finite(c) -> Column:
    """NaN and ±inf → NULL; keeps everything else."""
    c = col_(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def pct_change(cur, prev, places: int = 2) -> Column:
    """(cur - prev) / prev * 100, rounded half-even; NULL when prev is 0/NULL."""
    return F.bround(sdiv(col_(cur) - col_(prev), prev) * 100, places)
