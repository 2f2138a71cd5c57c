"""Date and calendar scalar expressions (#87, #89-93, #98-99, #101, #105, #107)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def c_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    return F.trunc(c_(c), "MM")


def days_in_month(c) -> Column:
    return F.dayofmonth(F.last_day(c_(c)))


def date_parts(c) -> dict[str, Column]:
    """month, quarter, year, month-start/end flags, days in month, Fourier terms."""
    d = c_(c)
    m = F.month(d)
    two_pi = 2.0 * math.pi
    return {
        "month": m,
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "days_in_month": days_in_month(d),
        "fourier_year_sin": F.sin(F.lit(two_pi) * m / 12),
        "fourier_year_cos": F.cos(F.lit(two_pi) * m / 12),
        "quarter_sin": F.sin(F.lit(two_pi) * (F.quarter(d) - 1) / 4),
        "quarter_cos": F.cos(F.lit(two_pi) * (F.quarter(d) - 1) / 4),
    }


def season_code(month) -> Column:
    """Dec-Feb 1, Mar-May 2, Jun-Sep 3, Oct-Nov 4."""
    m = c_(month)
    return (F.when(m.isin(12, 1, 2), 1).when(m.isin(3, 4, 5), 2)
            .when(m.isin(6, 7, 8, 9), 3).when(m.isin(10, 11), 4))


def last_friday_of_november(year) -> Column:
    nov30 = F.make_date(c_(year), F.lit(11), F.lit(30))
    return F.next_day(F.date_sub(nov30, 7), "Fri")


def black_friday_week(d) -> Column:
    """Within ±3 days of the last Friday of November of the same year."""
    d = c_(d)
    bf = last_friday_of_november(F.year(d))
    return (F.abs(F.datediff(d, bf)) <= 3).cast("int")


def month_day_in(d, mmdd) -> Column:
    return F.date_format(c_(d), "MM-dd").isin(list(mmdd)).cast("int")


def slug(c) -> Column:
    """lower-case with spaces as underscores (path component)."""
    return F.replace(F.lower(c_(c)), F.lit(" "), F.lit("_"))


def key_month_label(key, d) -> Column:
    """``key_yyyy-MM`` row label."""
    return F.concat_ws("_", c_(key), F.date_format(c_(d), "yyyy-MM"))
