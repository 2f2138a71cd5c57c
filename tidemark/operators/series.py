"""Dirty external month series and date-format detection (#88, #106)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Three-letter English month abbreviations in calendar order.
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Candidate date formats in the order they are tried, as
# (label, Spark pattern). Labels are strptime-style; the two no-padding
# patterns "%-m/%-d/%Y" and "%-d/%-m/%Y" never parse in the reference and are
# therefore left out.
DATE_FORMATS: Sequence[tuple[str, str]] = (
    ("%m-%d-%Y", "M-d-yyyy"),
    ("%Y-%m-%d", "yyyy-M-d"),
    ("%m/%d/%Y", "M/d/yyyy"),
    ("%Y/%m/%d", "yyyy/M/d"),
    ("%d-%m-%Y", "d-M-yyyy"),
    ("%Y/%m/%d %H:%M:%S", "yyyy/M/d H:m:s"),
    ("%m-%d-%Y %H:%M:%S", "M-d-yyyy H:m:s"),
    ("%m-%d-%Y %I:%M %p", "M-d-yyyy h:m a"),
    ("%d-%b-%Y", "d-MMM-yyyy"),
    ("%Y%m%d", "yyyyMMdd"),
)


def month_number(name: Column) -> Column:
    """Month number from a month name of any length ≥ 3 (first three letters)."""
    m = F.create_map(*[x for i, a in enumerate(MONTH_ABBR) for x in (F.lit(a), F.lit(i + 1))])
    return F.element_at(m, F.initcap(F.substring(name, 1, 3)))


def clean_number(text: Column) -> Column:
    """Drop thousands commas and no-break spaces, then parse (NULL if not a number)."""
    return F.regexp_replace(text, "[,\u00a0]", "").try_cast("bigint")


def clean_month_series(df: DataFrame, year: str = "year", month: str = "month",
                       value: str = "tourists") -> DataFrame:
    m = month_number(F.col(month))
    return df.select(F.make_date(F.col(year), m, F.lit(1)).alias("date"),
                     F.col(year).cast("int").alias("year"), m.alias("month"),
                     clean_number(F.col(value)).alias(value))


def detect_date_format(df: DataFrame, col: str, formats=DATE_FORMATS) -> DataFrame:
    """Parse ``col`` with the first format that parses every non-null value (S11).

    One aggregate counts the failures of every candidate format in a single
    pass; the chosen pattern is applied with a CASE over the candidates. If
    none fits, the column is left as it is. Adds ``date_format_used``.
    """
    x = F.col(col)
    fails = df.agg(*[F.count_if(x.isNotNull() & F.try_to_timestamp(x, F.lit(p)).isNull())
                     .alias(f"_f{i}") for i, (_, p) in enumerate(formats)])
    pick = F.lit(None).cast("int")
    for i in reversed(range(len(formats))):
        pick = F.when(F.col(f"_f{i}") == 0, F.lit(i)).otherwise(pick)
    chosen = fails.select(pick).scalar()
    parsed = F.lit(None).cast("date")
    label = F.lit(None).cast("string")
    for i, (lab, p) in enumerate(formats):
        parsed = F.when(chosen == i, F.to_date(F.try_to_timestamp(x, F.lit(p)))).otherwise(parsed)
        label = F.when(chosen == i, F.lit(lab)).otherwise(label)
    return df.withColumns({"parsed_date": parsed, "date_format_used": label})
